import datetime as dt

from monthgrid.catalog import GAS_SUITE, PETROLEUM_SUITE, PUBLISHED_RANGES, PUBLISHED_SERIES
from monthgrid.operators.quality import column_tests, quality_gate, run_battery, run_suite, suite_summary, suite_totals
from monthgrid.sinks.tables import quality_log

SCHEMA = "series_id string, period string, value double"
W, B, P = "PET.RWTC.M", "PET.RBRTE.M", "PET.MCRFPUS2.M"
AS_OF = "2026-06-30"


def month(i):
    return f"{2000 + i // 12}-{i % 12 + 1:02d}"


def good(n=40):
    return [(s, month(i), v) for i in range(n) for s, v in ((W, 60.0), (B, 65.5), (P, 9000.0))]


def results(spark, rows, suite=PETROLEUM_SUITE, schema=SCHEMA):
    return {r["expectation"]: (r["passed"], r["details"]) for r in run_suite(spark.createDataFrame(rows, schema), suite, AS_OF).collect()}


def test_catalog_has_seventeen_series_and_eleven_ranges():
    assert len(PUBLISHED_SERIES) == 17 and len({s for _, s, _, _ in PUBLISHED_SERIES}) == 17
    assert len(PUBLISHED_RANGES) == 11


def test_clean_table_passes_all_ten(spark):
    r = results(spark, good())
    assert len(r) == 10 and all(p for p, _ in r.values())
    assert r["expect_wti_price_in_range"][1] == "WTI: from 60.00 to 60.00, as expected"


def test_every_kind_of_failure_is_found(spark):
    rows = good() + [(None, "2001-01", 1.0), (W, None, 1.0), (W, "2030-01", 250.0), (W, "1980-01", 5.0), ("NEW", "2001-01", 1.0),
                     (B, "2000-01", 65.5), (B, "2000-01", -1.0)] + [(P, f"junk{i}", None) for i in range(10)]
    r = results(spark, rows)
    failed = {k: v[1] for k, v in r.items() if not v[0]}
    assert failed == {
        "expect_no_null_series_id": "series_id is NULL in 1 rows",
        "expect_no_null_period": "period is NULL in 1 rows",
        "expect_no_null_value": "value is NULL in 10 rows, 7.3%, allowed 5.0%",
        "expect_valid_series_ids": "ids outside the catalog: 1",
        "expect_wti_price_in_range": "WTI: 1 rows beyond 0.0 to 200.0",
        "expect_brent_price_in_range": "Brent: 1 rows beyond 0.0 to 200.0",
        "expect_no_future_periods": "rows dated ahead: 1",
        "expect_no_duplicate_rows": "repeats of a series and period: 2",
        "expect_period_not_before_min_date": "rows dated before 1986-01-01: 1",
    }


def test_null_keys_count_as_equal_duplicates(spark):
    r = results(spark, good() + [(None, None, 1.0)] * 3)
    assert r["expect_no_duplicate_rows"] == (False, "repeats of a series and period: 2")


def test_absent_series_is_skipped_and_empty_table_has_zero_percent_nulls(spark):
    r = results(spark, [], GAS_SUITE)
    assert len(r) == 11
    assert r["expect_henry_hub_price_in_range"] == (True, "not judged, no rows of Henry Hub")
    assert r["expect_henry_hub_not_negative"] == (True, "not judged, the series has no rows")
    assert r["expect_no_null_value"] == (True, "value is NULL in 0 rows, 0.0%, allowed 5.0%")
    assert r["expect_minimum_row_count"] == (False, "rows: 0, needed: 100")


def test_range_bounds_are_inclusive(spark):
    rows = [("NG.RNGWHHD.M", month(i), v) for i, v in enumerate([0.0, 25.0])] + [("NG.RNGWHHD.M", month(9), 25.01)]
    assert results(spark, rows[:2], GAS_SUITE)["expect_henry_hub_price_in_range"][0]
    assert not results(spark, rows, GAS_SUITE)["expect_henry_hub_price_in_range"][0]


def test_missing_columns_fail_their_own_checks(spark):
    df = spark.createDataFrame(good(), SCHEMA).drop("period")
    r = {x["expectation"]: x for x in run_suite(df, PETROLEUM_SUITE, AS_OF).collect()}
    assert r["expect_no_future_periods"]["details"] == "not judged, a column is missing"
    assert not r["expect_no_duplicate_rows"]["passed"] and r["expect_no_null_value"]["passed"]


def test_battery_and_its_variants(spark):
    rows = [("hdd", dt.date(2020, m, 1), 10.0 * m, "EIA_STEO") for m in (1, 2, 3)]
    rows += [("cdd", dt.date(2020, 1, 1), 5.0, None), ("cdd", dt.date(2020, 1, 1), 5.0, "EIA_STEO")]
    ranges = {"hdd": (0, 2000), "cdd": (0, 4), "opec_spare": (-1, 15)}
    df = spark.createDataFrame(rows, "series string, period date, value double, source string")
    r = {(x["suite"], x["expectation"]): x["passed"] for x in run_battery(df, ranges).collect()}
    assert len(r) == 27
    assert all(v for (s, _), v in r.items() if s == "hdd_suite")
    assert {e for (s, e), v in r.items() if s == "cdd_suite" and not v} == {"value_in_range", "value_has_variance", "period_no_duplicates", "source_tag_present"}
    assert {e for (s, e), v in r.items() if s == "opec_spare_suite" and not v} == {"table_not_empty", "value_has_variance"}
    bare = run_battery(df.drop("value", "source"), {"hdd": (0, 2000)})
    assert {x["expectation"]: x["passed"] for x in bare.collect()} == {
        "table_not_empty": True, "has_value_column": False, "has_period_column": True, "period_no_nulls": True, "period_no_duplicates": True}


def test_totals_summary_gate_and_log(spark):
    rows = [("a", f"e{i}", None, i > 0, "x") for i in range(5)] + [("b", "e", None, True, "y")]
    res = spark.createDataFrame(rows, "suite string, expectation string, column string, passed boolean, details string")
    t = {r["suite"]: r for r in suite_totals(res).collect()}
    assert (t["a"]["total_expectations"], t["a"]["passed"], t["a"]["failed"], t["a"]["success_rate"], t["a"]["is_passing"]) == (5, 4, 1, 80.0, False)
    assert t["b"]["is_passing"]
    assert quality_gate(suite_totals(res)).first()["gate_passed"]
    assert not quality_gate(suite_totals(res), 80.1).first()["gate_passed"]
    assert not quality_gate(suite_totals(res.filter("false"))).first()["gate_passed"]
    assert "FAIL e0 - x" in [r["line"] for r in suite_summary(res).collect()]
    zero = spark.createDataFrame([("s", 0, 0, 0)], "suite string, total_expectations long, passed long, failed long")
    assert quality_log(zero).first()["success_rate"] == 0.0


def test_column_tests(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "z"), (None, None)], "k int, c string")
    r = {(x["test_name"], x["column_name"]): x["n_failures"] for x in column_tests(df, ["k", "c"], ["k"], {"c": ["a", "b"]}).collect()}
    assert r == {("not_null", "k"): 2, ("not_null", "c"): 1, ("unique", "k"): 1, ("accepted_values", "c"): 1}


def test_column_tests_take_two_shuffles_whatever_their_number(spark):
    from monthgrid.operators.quality import column_tests
    from test_plans import plan

    df = spark.createDataFrame([(1, "a", True, None), (1, "b", None, None), (2, None, False, 3.0)], "x int, y string, z boolean, w double")
    got = {(r["test_name"], r["column_name"]): r["n_failures"] for r in column_tests(df, ["x", "z", "w"], ["x", "y", "z", "w"], {"y": ["a"], "z": [True]}).collect()}
    assert got == {("not_null", "x"): 0, ("not_null", "z"): 1, ("not_null", "w"): 2, ("accepted_values", "y"): 1, ("accepted_values", "z"): 1,
                   ("unique", "x"): 1, ("unique", "y"): 0, ("unique", "z"): 0, ("unique", "w"): 0}
    some, many = (plan(column_tests(df, ["x"], c)).count("Exchange hashpartitioning") for c in (["x"], ["x", "y", "z", "w"]))
    assert some == many == 2
    assert column_tests(df.limit(0), ["x"], ["x", "y"]).filter("passed").count() == 3
    assert column_tests(df, unique=["y"]).collect()[0]["passed"]

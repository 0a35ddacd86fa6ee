import datetime as dt

import pytest
from conftest import by_period
from monthgrid.catalog import Domain
from monthgrid.functions import scalars as S
from monthgrid.functions import windows as X
from monthgrid.functions.scalars import round_half_up
from monthgrid.operators.cells import clean, grid, keep_latest, latest_cells, latest_key, latest_parts, mean_cells, null_counts, pivot_cells, pivot_measures, unpivot
from monthgrid.plans.medallion import gold, silver
from pyspark.sql import functions as F

OBS = "series_id string, period date, value double, ingested_at timestamp"


def d(text):
    return dt.date.fromisoformat(text)


def at(text):
    return dt.datetime.fromisoformat(text)


def test_clean_keeps_zero_and_drops_null_and_negative(spark):
    rows = [("a", d("2020-01-01"), 0.0, None), ("a", d("2020-01-01"), -0.1, None), ("a", None, 1.0, None), ("a", d("2020-02-01"), None, None)]
    assert [r["value"] for r in clean(spark.createDataFrame(rows, OBS)).collect()] == [0.0]


def test_latest_wins_and_ties_take_the_larger_value(spark):
    rows = [("a", d("2020-01-05"), 9.0, at("2020-02-01")), ("a", d("2020-01-20"), 3.0, at("2020-03-01")),
            ("a", d("2020-01-07"), 4.0, at("2020-03-01")), ("b", d("2020-01-01"), 7.0, None)]
    cells = latest_cells(spark.createDataFrame(rows, OBS), ["series_id"], stamp=True)
    assert {(r["series_id"], r["period"]): r["value"] for r in cells.collect()} == {("a", d("2020-01-01")): 4.0, ("b", d("2020-01-01")): 7.0}
    assert {r["series_id"]: r["ingested_at"] for r in cells.collect()} == {"a": at("2020-03-01"), "b": at("1970-01-01")}


def partial_rows(df):
    """Rows that the first aggregate of an executed plan handed on."""
    df.collect()
    plan, out = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            node = node.executedPlan()
        if node.nodeName().endswith("QueryStage"):
            node = node.plan()
        out.append(node)
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(plan)
    aggregates = [n for n in out if "Aggregate" in n.nodeName()]
    return aggregates[-1].metrics().apply("numOutputRows").value(), {n.nodeName() for n in out}


def test_latest_sends_one_row_per_key_and_task_though_every_row_has_its_own_time(spark):
    rows = spark.range(0, 40000, 1, 4).select((F.col("id") % 3).cast("string").alias("series_id"), F.lit("2020-01-15").cast("date").alias("period"),
                                              (F.col("id") % 101).cast("double").alias("value"), F.timestamp_micros(F.col("id") * 977).alias("ingested_at"))
    sent, nodes = partial_rows(latest_cells(rows, ["series_id"]))
    assert sent == 3 * 4 and "HashAggregate" in nodes and not nodes & {"SortAggregate", "Sort"}
    assert {r["series_id"]: r["value"] for r in latest_cells(rows, ["series_id"]).collect()} == {str(k % 3): float(k % 101) for k in (39997, 39998, 39999)}


def test_packed_key_keeps_order_and_value(spark):
    times = [at("0002-01-01"), at("1969-12-31T23:59:59.999999"), at("2020-01-01"), at("9998-12-31T23:59:59.999999")]
    values = [-2.2e11, -1.00005, -0.0001, 0.0, 0.00005, 123456789.1234, 2.2e11]
    df = spark.createDataFrame([(t, v) for t in times for v in values], "t timestamp, v double")
    keyed = df.withColumn("k", latest_key(F.col("t"), F.col("v")))
    got = keyed.orderBy("k").select("t", "v", latest_parts("k")[1].alias("back"), latest_parts("k")[0].alias("when"), round_half_up("v").alias("r")).collect()
    assert [(r["t"], r["v"]) for r in got] == [(t, v) for t in times for v in values]
    assert all(r["back"] == r["r"] and r["when"] == r["t"] for r in got)


@pytest.mark.parametrize("value", [1e12, float("nan"), float("inf"), -1e15])
def test_packed_key_raises_beyond_its_range(spark, value):
    with pytest.raises(Exception, match="out of range"):
        spark.createDataFrame([(at("2020-01-01"), value)], "t timestamp, v double").select(latest_key(F.col("t"), F.col("v"))).collect()


def test_keep_latest_takes_the_payload_of_one_row(spark):
    rows = [("a", d("2020-01-01"), 9.0, at("2020-02-01")), ("a", d("2020-01-01"), 1.0, at("2020-03-01"))]
    r = keep_latest(spark.createDataFrame(rows, OBS), ["series_id", "period"], ["value", "ingested_at"]).first()
    assert (r["value"], r["ingested_at"]) == (1.0, at("2020-03-01"))


def test_a_hot_series_shuffles_one_row_per_month_and_task(spark):
    hot = spark.range(0, 30000, 1, 8).select(
        F.lit("hot").alias("series_id"), F.lit("2020-01-15").cast("date").alias("period"), F.col("id").cast("double").alias("value"),
        F.timestamp_seconds(F.col("id") % 7).alias("ingested_at"))
    assert [r["value"] for r in latest_cells(hot, ["series_id"]).collect()] == [29994.0]
    assert [r["value"] for r in mean_cells(hot, ["series_id"]).collect()] == [14999.5]


def test_mean_rounds_half_up_whatever_the_order(spark):
    values = [100.01, 100.02, 100.03, 100.04, 100.05, 100.06, 100.07, 100.0]
    rows = [("a", d("2020-01-01"), v, None) for v in values]
    for r in (rows, rows[::-1]):
        assert mean_cells(spark.createDataFrame(r, OBS), ["series_id"]).first()["value"] == 100.035
    one = spark.createDataFrame([(0.00125,), (-0.00125,), (0.00124999,), (None,)], "x double")
    assert [r[0] for r in one.select(S.round_half_up("x")).collect()] == [0.0013, -0.0013, 0.0012, None]


def test_pivot_and_grid_complete_missing_months(spark, monthly):
    cells = monthly({"a": [1, 2, "gap"], "b": ["gap", 5, 6]})
    wide = by_period(pivot_cells(cells, ["a", "b"], "series"), "a", "b")
    assert sorted(wide.items()) == [(d("2018-01-01"), (1.0, None)), (d("2018-02-01"), (2.0, 5.0)), (d("2018-03-01"), (None, 6.0))]
    assert grid(cells, ["a", "b"]).count() == 6
    assert unpivot(pivot_cells(cells, ["a", "b"], "series"), ["a", "b"]).filter("value IS NULL").count() == 2


def test_empty_input_gives_empty_tables(spark, monthly):
    empty = spark.createDataFrame([], OBS)
    domain = Domain({"p": "a", "q": "b"}, "p", "mom", ("q", "p"))
    assert silver(empty, domain).count() == 0
    assert null_counts(monthly({"a": []}), ["value"]).first()["n_null"] == 0


def _domain_obs(spark, series, start=2018):
    import pandas as pd
    rows = []
    for sid, values in series.items():
        for m, v in zip(pd.date_range(f"{start}-01-01", periods=len(values), freq="MS"), values):
            if v is not None:
                rows.append((sid, m.date(), float(v), m.to_pydatetime()))
    return spark.createDataFrame(rows, OBS)


OIL = Domain({"wti_price": "w", "brent_price": "b", "us_production": "p"}, "wti_price", "wti_mom_change", ("brent_price", "wti_price"))
GAS = Domain({"henry_hub_price": "h", "us_storage_bcf": "s", "us_production": "p"}, "henry_hub_price", "price_mom_change")


def test_change_counts_rows_of_the_table_not_of_the_series(spark):
    # February has a row (another series reports), so March's predecessor is February's NULL
    s = silver(_domain_obs(spark, {"w": [100, None, 110], "b": [101, 102, 103]}), OIL)
    assert by_period(s, "wti_mom_change") == {d("2018-01-01"): None, d("2018-02-01"): None, d("2018-03-01"): None}
    # without any February row January is the predecessor
    s = silver(_domain_obs(spark, {"w": [100, None, 110], "b": [101, None, 103]}), OIL)
    assert by_period(s, "wti_mom_change") == {d("2018-01-01"): None, d("2018-03-01"): 10.0}


def test_zero_price_gives_null_change_and_outlier_is_flagged(spark):
    s = silver(_domain_obs(spark, {"w": [0, 10] + [10] * 30 + [500], "b": [1] * 33}), OIL)
    out = by_period(s, "wti_mom_change", "is_outlier", "price_spread")
    assert out[d("2018-02-01")] == (None, False, -9.0)
    assert [p for p, v in out.items() if v[1]] == [d("2020-09-01")]


def test_gold_joins_one_sided_months(spark):
    oil = silver(_domain_obs(spark, {"w": [60] * 13, "b": [61] * 13}), OIL)
    gas = silver(_domain_obs(spark, {"h": [3, 0, 4]}, 2019), GAS)
    g = by_period(gold(oil, gas), "wti_price", "henry_hub_price", "oil_gas_ratio", "wti_yoy_change", "has_outlier")
    assert g[d("2018-01-01")] == (60.0, None, None, None, False)
    assert g[d("2019-01-01")] == (60.0, 3.0, 20.0, 0.0, False)
    assert g[d("2019-02-01")] == (None, 0.0, None, None, False)
    assert len(g) == 15


def test_scalars(spark):
    df = spark.createDataFrame([("2020-02", "1.5"), ("2020-02-17", "."), ("junk", "-3"), (None, None)], "p string, v string")
    got = df.select(S.parse_period("p").alias("p"), S.parse_number("v").alias("v")).collect()
    assert [tuple(r) for r in got] == [(d("2020-02-01"), 1.5), (d("2020-02-17"), None), (None, -3.0), (None, None)]
    one = spark.range(1).select(S.safe_divide(F.lit(1.0), F.lit(0.0)), S.pct_change(F.lit(3.0), F.lit(2.0)),
                                S.title_label(F.lit("wti_price")), S.window_label(F.lit(7), {96: "calm"})).first()
    assert tuple(one) == (None, 50.0, "Wti Price", "7-month train")


def test_three_sigma_of_a_constant_series_flags_nothing(monthly):
    assert monthly({"a": [5] * 10}).filter("true").select(X.three_sigma("value", "series").alias("f")).filter("f").count() == 0


@pytest.mark.parametrize("n", [3, 300])
def test_pivot_of_measures_has_one_form_at_every_width(spark, n):
    ids = [f"s{i}" for i in range(n)]
    df = spark.createDataFrame([("2020-01-01", s, 1.0) for s in ids] + [("2020-01-01", "s0", 5.0)], "period string, series string, m double")
    out = pivot_measures(df, ids, ["m"])
    assert out.columns == ["period", *[f"{s}_m" for s in ids]]
    assert out.first()["s0_m"] == 5.0 and out.first()["s2_m"] == 1.0

"""Data-quality queries."""

from pyspark.sql import functions as F

from monthgrid.catalog import RangeRule, Suite
from monthgrid.functions.scalars import stable_id
from monthgrid.operators.quality import (column_tests, quality_gate, run_battery, run_suite, suite_summary, suite_totals)
from monthgrid.registry.core import GAS, all_obs_sql, query
from monthgrid.registry.medallion import GOLD, SILVER_GAS, SILVER_OIL, gold_df, silver_gas_df, silver_oil_df
from monthgrid.sinks.tables import quality_log
from monthgrid.sources.tables import DRIVER_FEATURES, all_observations, feature_name, gas_observations, table

AS_OF = "2001-06-30"
DRIVER_OIL_SUITE = Suite(
    name="petroleum_suite", valid_series=("1-URGENT", "2-HIGH", "3-MEDIUM"),
    ranges=(RangeRule("expect_wti_price_in_range", "1-URGENT", 0.0, 400000.0, "WTI"),
            RangeRule("expect_brent_price_in_range", "2-HIGH", 0.0, 600000.0, "Brent")),
    min_date="1995-02-01")
DRIVER_GAS_SUITE = Suite(
    name="gas_suite", valid_series=("A", "N", "R"),
    ranges=(RangeRule("expect_henry_hub_price_in_range", "A", 0.0, 200000.0, "Henry Hub"),
            RangeRule("expect_storage_in_range", "N", 0.0, 50000.0, "storage")),
    min_date="1993-01-01", not_negative=(("expect_henry_hub_not_negative", "A"),))
DRIVER_RANGES = {
    "crude_imports": (0, 600000), "refinery_util": (0, 100), "gasoline_stocks": (0, 600000),
    "distillate_stocks": (0, 600000), "hdd": (1000, 600000), "cdd": (0, 200000), "opec_spare": (-1, 15),
    "global_inv": (0, 200000), "dollar_index": (50, 200000), "industrial_production": (50, 150), "treasury_10y": (-2, 200000),
}


def oil_bronze(spark, sf):
    """Orders as bronze rows; a pending order has no value yet and an old one of low priority no series."""
    return table(spark, sf, "orders").select(
        F.when((F.col("o_orderpriority") != "5-LOW") | (F.col("o_orderdate") >= F.lit("1995-03-01").cast("timestamp_ntz")),
               F.col("o_orderpriority")).alias("series_id"),
        F.col("o_orderdate").cast("date").alias("period"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("value"))


OIL_BRONZE = """b AS (SELECT CASE WHEN o_orderpriority <> '5-LOW' OR o_orderdate >= TIMESTAMP '1995-03-01' THEN o_orderpriority END AS series_id,
  CAST(o_orderdate AS DATE) AS period, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS value FROM orders)"""
GAS_BRONZE = f"{GAS}, b AS (SELECT series_id, period, value FROM gas)"


def suite_selects(s, b):
    """Each expectation as its own SELECT over the bronze rows ``b``."""
    def one(name, column, passed, details, src=b):
        c = "NULL" if column is None else f"'{column}'"
        return f"SELECT '{s.name}' AS suite, '{name}' AS expectation, {c} AS \"column\", {passed} AS passed, {details} AS details FROM {src}"

    def zero(name, column, cond, bad, good):
        n = f"count(*) FILTER (WHERE {cond})"
        return one(name, column, f"{n} = 0", f"CASE WHEN {n} > 0 THEN printf('{bad}', {n}) ELSE '{good}' END")

    parts = [
        zero("expect_no_null_series_id", "series_id", "series_id IS NULL", "series_id is NULL in %d rows", "series_id is never NULL"),
        zero("expect_no_null_period", "period", "period IS NULL", "period is NULL in %d rows", "period is never NULL"),
        one("expect_no_null_value", "value", f"count(*) FILTER (WHERE value IS NULL) * 100.0 / count(*) <= {s.max_null_pct}",
            f"printf('value is NULL in %d rows, %.1f%%, allowed {s.max_null_pct}%%', count(*) FILTER (WHERE value IS NULL), CAST(count(*) FILTER (WHERE value IS NULL) * 100.0 / count(*) AS DOUBLE))"),
    ]
    valid = ", ".join(f"'{v}'" for v in s.valid_series)
    n = f"count(DISTINCT series_id) FILTER (WHERE series_id NOT IN ({valid}))"
    parts.append(one("expect_valid_series_ids", "series_id", f"{n} = 0", f"CASE WHEN {n} > 0 THEN printf('ids outside the catalog: %d', {n}) ELSE 'every id is in the catalog' END"))
    for r in s.ranges:
        out = f"count(*) FILTER (WHERE value < {r.low} OR value > {r.high})"
        parts.append(one(r.expectation, "value", f"{out} = 0",
                         f"CASE WHEN count(*) = 0 THEN 'not judged, no rows of {r.label}' WHEN {out} > 0 THEN printf('{r.label}: %d rows beyond {r.low} to {r.high}', {out}) "
                         f"ELSE printf('{r.label}: from %.2f to %.2f, as expected', min(value), max(value)) END",
                         f"(SELECT value FROM {b} WHERE series_id = '{r.series_id}' AND value IS NOT NULL)"))
    parts += [
        zero("expect_no_future_periods", "period", f"period > DATE '{AS_OF}'", "rows dated ahead: %d", "nothing is dated ahead"),
        one("expect_no_duplicate_rows", "series_id, period", "coalesce(sum(n - 1), 0) = 0",
            "CASE WHEN coalesce(sum(n - 1), 0) > 0 THEN printf('repeats of a series and period: %d', CAST(sum(n - 1) AS BIGINT)) ELSE 'each series and period once' END",
            f"(SELECT count(*) AS n FROM {b} GROUP BY series_id, period)"),
        one("expect_minimum_row_count", None, f"count(*) >= {s.min_rows}", f"printf('rows: %d, needed: {s.min_rows}', count(*))"),
        zero("expect_period_not_before_min_date", "period", f"period < DATE '{s.min_date}'", f"rows dated before {s.min_date}: %d", f"nothing dated before {s.min_date}"),
    ]
    for name, sid in s.not_negative:
        parts.append(zero(name, "value", f"series_id = '{sid}' AND value < 0", "rows below zero: %d", "nothing below zero"))
    return " UNION ALL ".join(parts)


def suite_sql(bronze, s):
    return f"WITH {bronze}, res AS ({suite_selects(s, 'b')})"


OIL_SUITE_SQL = suite_sql(OIL_BRONZE, DRIVER_OIL_SUITE)
GAS_SUITE_SQL = suite_sql(GAS_BRONZE, DRIVER_GAS_SUITE)


def oil_results(spark, sf):
    return run_suite(oil_bronze(spark, sf), DRIVER_OIL_SUITE, AS_OF)


def gas_results(spark, sf):
    return run_suite(gas_observations(spark, sf).select("series_id", "period", "value"), DRIVER_GAS_SUITE, AS_OF)


query("quality_oil", OIL_SUITE_SQL + " SELECT * FROM res")(oil_results)
query("quality_gas", GAS_SUITE_SQL + " SELECT * FROM res")(gas_results)


@query("quality_missing_column", OIL_SUITE_SQL + """ SELECT suite, expectation, "column",
  CASE WHEN "column" IN ('period', 'series_id, period') THEN false ELSE passed END AS passed,
  CASE WHEN "column" IN ('period', 'series_id, period') THEN 'not judged, a column is missing' ELSE details END AS details FROM res""")
def quality_missing_column(spark, sf):
    return run_suite(oil_bronze(spark, sf).drop("period"), DRIVER_OIL_SUITE, AS_OF)


_TOTALS = """SELECT suite, count(*) AS total_expectations, CAST(sum(CASE WHEN passed THEN 1 ELSE 0 END) AS BIGINT) AS passed,
  CAST(sum(CASE WHEN passed THEN 0 ELSE 1 END) AS BIGINT) AS failed, round(sum(CASE WHEN passed THEN 1 ELSE 0 END) * 100.0 / count(*), 2) AS success_rate,
  bool_and(passed) AS is_passing FROM res GROUP BY 1"""
query("suite_report", f"{OIL_SUITE_SQL} {_TOTALS}")(lambda spark, sf: suite_totals(oil_results(spark, sf)))
query("suite_summary", f"""{GAS_SUITE_SQL} SELECT suite, concat_ws(' ', CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END, expectation, '-', details) AS line FROM res""")(
    lambda spark, sf: suite_summary(gas_results(spark, sf)))


_BOTH = (f"WITH {OIL_BRONZE.replace('b AS', 'ob AS', 1)}, {GAS}, gb AS (SELECT series_id, period, value FROM gas), "
         f"res AS ({suite_selects(DRIVER_OIL_SUITE, 'ob')} UNION ALL {suite_selects(DRIVER_GAS_SUITE, 'gb')}), tot AS ({_TOTALS})")


def both_totals(spark, sf):
    return suite_totals(oil_results(spark, sf).unionByName(gas_results(spark, sf)))


query("suite_totals", f"{_BOTH} SELECT * FROM tot")(both_totals)
query("quality_gate", f"{_BOTH} SELECT min(success_rate) AS lowest_rate, bool_and(success_rate >= 80.0) AS gate_passed FROM tot")(
    lambda spark, sf: quality_gate(both_totals(spark, sf)))


@query("quality_log", f"{_BOTH} SELECT suite, total_expectations, passed, failed, success_rate FROM tot")
def quality_log_q(spark, sf):
    return quality_log(both_totals(spark, sf).select("suite", "total_expectations", "passed", "failed"))


# ---- the generic battery on the eleven exogenous series, month cells of one long frame ----

def exog_bronze(spark, sf):
    obs = all_observations(spark, sf).filter(F.col("provider").isin("segment", "part_type"))
    return obs.select(feature_name().alias("series"), "period", "value",
                      F.col("provider").alias("source"))


def _battery_sql():
    rows = ", ".join(f"('{s}', {float(lo)}, {float(hi)})" for s, (lo, hi) in DRIVER_RANGES.items())
    checks = [("table_not_empty", "count(x.series) > 0"), ("has_value_column", "true"), ("has_period_column", "true"),
              ("value_no_nulls", "count(x.series) = count(value)"), ("value_in_range", "coalesce(bool_and(value BETWEEN low AND high), true)"),
              ("value_has_variance", "count(DISTINCT value) > 1"), ("period_no_nulls", "count(x.series) = count(period)"),
              ("period_no_duplicates", "count(period) = count(DISTINCT period)"), ("source_tag_present", "count(x.series) = count(source)")]
    names = ", ".join(f"('{p}', '{s}', '{n}')" for p, m in DRIVER_FEATURES.items()
                      if p in ("segment", "part_type") for s, n in m.items())
    agg = ", ".join(f"{e} AS {n}" for n, e in checks)
    unp = ", ".join(n for n, _ in checks)
    return f"""WITH {all_obs_sql()}, names(provider, series_id, series) AS (VALUES {names}), spec(series, low, high) AS (VALUES {rows}),
x AS (SELECT series, period, value, provider AS source FROM obs JOIN names USING (provider, series_id)),
agg AS (SELECT spec.series || '_suite' AS suite, {agg} FROM spec LEFT JOIN x ON x.series = spec.series GROUP BY 1),
res AS (SELECT suite, expectation, passed FROM (UNPIVOT agg ON {unp} INTO NAME expectation VALUE passed))"""


BATTERY = _battery_sql()
query("quality_generic", f"{BATTERY} SELECT * FROM res")(lambda spark, sf: run_battery(exog_bronze(spark, sf), DRIVER_RANGES))
query("quality_generic_totals", f"{BATTERY} {_TOTALS}")(lambda spark, sf: suite_totals(run_battery(exog_bronze(spark, sf), DRIVER_RANGES)))


# The declared tests of the silver and gold tables. ``id`` is a hash of the month, the last column a load stamp.
_FLAG = [True, False]
DECLARED = {
    "silver_oil": (["id", "period", "wti_price", "is_outlier", "transformed_at"], ["id", "period"], {"is_outlier": _FLAG}),
    "silver_gas": (["id", "period", "henry_hub_price", "is_outlier"], ["id", "period"], {"is_outlier": _FLAG}),
    "gold": (["id", "period", "has_outlier", "created_at"], ["id", "period"], {"has_outlier": _FLAG}),
}


def _tests_sql(source, not_null, unique, accepted):
    """SQL of the declared tests on a table expression."""
    def row(test, c, n):
        return f"SELECT '{test}' AS test_name, '{c}' AS column_name, n AS n_failures, n = 0 AS passed FROM ({n})"

    rows = [row("not_null", c, f"SELECT count(*) FILTER (WHERE {c} IS NULL) AS n FROM {source}") for c in not_null]
    rows += [row("accepted_values", c, f"SELECT count(*) FILTER (WHERE {c} NOT IN ({', '.join(map(repr, v))})) AS n FROM {source}") for c, v in accepted.items()]
    rows += [row("unique", c, f"SELECT count(*) AS n FROM (SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)") for c in unique]
    return " UNION ALL ".join(rows)


def _stamped(df, *stamps):
    return df.select(stable_id("period").alias("id"), "*", *[F.current_timestamp().alias(c) for c in stamps])


@query("column_tests_gold", f"WITH {GOLD}, t AS (SELECT sha256(CAST(period AS VARCHAR)) AS id, *, now() AS created_at FROM gold) {_tests_sql('t', *DECLARED['gold'])}")
def column_tests_gold(spark, sf):
    return column_tests(_stamped(gold_df(spark, sf), "created_at"), *DECLARED["gold"])


@query("column_tests_silver_oil", f"WITH {SILVER_OIL}, t AS (SELECT sha256(CAST(period AS VARCHAR)) AS id, *, now() AS transformed_at FROM so) {_tests_sql('t', *DECLARED['silver_oil'])}")
def column_tests_silver_oil(spark, sf):
    return column_tests(_stamped(silver_oil_df(spark, sf), "transformed_at"), *DECLARED["silver_oil"])


@query("column_tests_silver_gas", f"WITH {SILVER_GAS}, t AS (SELECT sha256(CAST(period AS VARCHAR)) AS id, * FROM sg) {_tests_sql('t', *DECLARED['silver_gas'])}")
def column_tests_silver_gas(spark, sf):
    return column_tests(_stamped(silver_gas_df(spark, sf)), *DECLARED["silver_gas"])


_ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_BRONZE = (_ORDERS, _ORDERS, {"o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM"], "o_orderstatus": ["F", "O", "P"]})


@query("column_tests_bronze", _tests_sql("orders", *_BRONZE))
def column_tests_bronze(spark, sf):
    return column_tests(table(spark, sf, "orders"), *_BRONZE)

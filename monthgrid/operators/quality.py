"""Quality suites: one output row per expectation, from one reduction of the table.

Every suite first groups by (series_id, period), which counts duplicates and shrinks the table
map-side, then sums the groups' counters. The table is read and shuffled once, however many
expectations there are.
"""

from __future__ import annotations

from functools import reduce
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthgrid.catalog import MIN_GATE_RATE, Suite
from monthgrid.functions.scalars import parse_number, parse_period
from monthgrid.session import stage

_DATES = ("date", "timestamp", "timestamp_ntz")


def _n(cond: Column) -> Column:
    """How many rows satisfy a condition; NULL counts as no."""
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


def _total(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0)).cast("long").alias(name)


def _result(expectation: str, column: str | None, passed: Column, details: Column) -> Column:
    return F.struct(F.lit(expectation).alias("expectation"), F.lit(column).cast("string").alias("column"),
                    passed.alias("passed"), details.alias("details"))


def _either(n: str, bad: str, good: str | Column) -> Column:
    good_text = good if isinstance(good, Column) else F.lit(good)
    return F.when(F.col(n) > 0, F.format_string(bad, F.col(n))).otherwise(good_text)


def _zero(n: str) -> Column:
    return F.col(n) == 0


def run_suite(bronze: DataFrame, suite: Suite, as_of: str) -> DataFrame:
    """All expectations of a bronze suite as rows ``(suite, expectation, column, passed, details)``.

    Columns the table lacks fail their expectation with a message instead of failing the job.
    """
    has = {c: c in bronze.columns for c in ("series_id", "period", "value")}
    src = bronze
    for c in ("series_id", "period", "value"):
        if not has[c]:
            src = src.withColumn(c, F.lit(None).cast("string"))
    # parsed once per group, not per row
    day = F.col("_period").cast("date") if dict(src.dtypes)["period"] in _DATES else parse_period("_period")
    value = F.col("value").cast("double") if dict(src.dtypes)["value"] != "string" else parse_number("value")

    def of(sid: str) -> Column:
        return (F.col("series_id") == F.lit(sid)) & F.col("_v").isNotNull()

    first = [F.count(F.lit(1)).alias("n"), _n(F.col("_v").isNull()).alias("null_value")]
    for i, r in enumerate(suite.ranges):
        first += [_n(of(r.series_id)).alias(f"n_{i}"),
                  _n(of(r.series_id) & ~F.col("_v").between(r.low, r.high)).alias(f"out_{i}"),
                  F.min(F.when(of(r.series_id), F.col("_v"))).alias(f"min_{i}"),
                  F.max(F.when(of(r.series_id), F.col("_v"))).alias(f"max_{i}")]
    for i, (_, sid) in enumerate(suite.not_negative):
        first += [_n(of(sid)).alias(f"nn_n_{i}"), _n(of(sid) & (F.col("_v") < 0)).alias(f"nn_bad_{i}")]
    groups = (src.select("series_id", F.col("period").alias("_period"), value.alias("_v"))
              .groupBy("series_id", "_period").agg(*first).withColumn("_day", day))

    unknown = F.col("series_id").isNotNull() & ~F.col("series_id").isin(list(suite.valid_series))
    per_id = groups.groupBy("series_id").agg(
        _total("n"), _total("null_value"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("dupes"),
        F.coalesce(F.sum(F.when(F.col("_period").isNull(), F.col("n"))), F.lit(0)).cast("long").alias("null_period"),
        F.coalesce(F.sum(F.when(F.col("_day") > F.to_date(F.lit(as_of)), F.col("n"))), F.lit(0)).cast("long").alias("future"),
        F.coalesce(F.sum(F.when(F.col("_day") < F.to_date(F.lit(suite.min_date)), F.col("n"))), F.lit(0)).cast("long").alias("old"),
        *[_total(f"{p}_{i}") for i in range(len(suite.ranges)) for p in ("n", "out")],
        *[F.min(f"min_{i}").alias(f"min_{i}") for i in range(len(suite.ranges))],
        *[F.max(f"max_{i}").alias(f"max_{i}") for i in range(len(suite.ranges))],
        *[_total(f"nn_{p}_{i}") for i in range(len(suite.not_negative)) for p in ("n", "bad")])
    sums = ["n", "null_value", "dupes", "null_period", "future", "old",
            *[f"{p}_{i}" for i in range(len(suite.ranges)) for p in ("n", "out")],
            *[f"nn_{p}_{i}" for i in range(len(suite.not_negative)) for p in ("n", "bad")]]
    one = per_id.agg(
        F.coalesce(F.sum(F.when(F.col("series_id").isNull(), F.col("n"))), F.lit(0)).cast("long").alias("null_id"),
        _n(unknown).alias("unknown"),
        *[_total(s) for s in sums],
        *[F.min(f"min_{i}").alias(f"min_{i}") for i in range(len(suite.ranges))],
        *[F.max(f"max_{i}").alias(f"max_{i}") for i in range(len(suite.ranges))])
    one = one.withColumn("unknown", F.coalesce("unknown", F.lit(0)))
    null_pct = F.when(F.col("n") > 0, F.col("null_value") / F.col("n") * 100).otherwise(F.lit(0.0))

    rows = [
        _result("expect_no_null_series_id", "series_id", _zero("null_id"),
                _either("null_id", "series_id is NULL in %d rows", "series_id is never NULL")),
        _result("expect_no_null_period", "period", _zero("null_period"),
                _either("null_period", "period is NULL in %d rows", "period is never NULL")),
        _result("expect_no_null_value", "value", null_pct <= suite.max_null_pct,
                F.format_string(f"value is NULL in %d rows, %.1f%%, allowed {suite.max_null_pct}%%", F.col("null_value"), null_pct)),
        _result("expect_valid_series_ids", "series_id", _zero("unknown"),
                _either("unknown", "ids outside the catalog: %d", "every id is in the catalog")),
    ]
    for i, r in enumerate(suite.ranges):
        ok = F.format_string(f"{r.label}: from %.2f to %.2f, as expected", F.col(f"min_{i}"), F.col(f"max_{i}"))
        rows.append(_result(r.expectation, "value", _zero(f"out_{i}"),
                            F.when(F.col(f"n_{i}") == 0, F.lit(f"not judged, no rows of {r.label}"))
                            .otherwise(_either(f"out_{i}", f"{r.label}: %d rows beyond {r.low} to {r.high}", ok))))
    rows += [
        _result("expect_no_future_periods", "period", _zero("future"),
                _either("future", "rows dated ahead: %d", "nothing is dated ahead")),
        _result("expect_no_duplicate_rows", "series_id, period", _zero("dupes"),
                _either("dupes", "repeats of a series and period: %d", "each series and period once")),
        _result("expect_minimum_row_count", None, F.col("n") >= suite.min_rows,
                F.format_string(f"rows: %d, needed: {suite.min_rows}", F.col("n"))),
        _result("expect_period_not_before_min_date", "period", _zero("old"),
                _either("old", f"rows dated before {suite.min_date}: %d", f"nothing dated before {suite.min_date}")),
    ]
    for i, (name, sid) in enumerate(suite.not_negative):
        rows.append(_result(name, "value", _zero(f"nn_bad_{i}"),
                            F.when(F.col(f"nn_n_{i}") == 0, F.lit("not judged, the series has no rows"))
                            .otherwise(_either(f"nn_bad_{i}", "rows below zero: %d", "nothing below zero"))))
    out = one.select(F.explode(F.array(*rows)).alias("r")).select(F.lit(suite.name).alias("suite"), "r.*")

    needs = {"series_id": ("series_id",), "period": ("period",), "value": ("value",), "series_id, period": ("series_id", "period")}
    gone = [c for c, need in needs.items() if not all(has[x] for x in need)]
    if gone:
        lost = F.col("column").isin(gone)
        out = out.select("suite", "expectation", "column",
                         F.when(lost, F.lit(False)).otherwise(F.col("passed")).alias("passed"),
                         F.when(lost, F.lit("not judged, a column is missing")).otherwise(F.col("details")).alias("details"))
    return out


def run_battery(bronze: DataFrame, ranges: Mapping[str, tuple[float, float]], series: str = "series") -> DataFrame:
    """The generic battery (up to nine checks) on every single-series table held in one long frame.

    Checks of a column the frame lacks are left out. A listed series without rows fails
    ``table_not_empty`` and passes the rest, as an empty table does.
    """
    cols = set(bronze.columns)
    spark = bronze.sparkSession
    spec = spark.createDataFrame([(s, float(lo), float(hi)) for s, (lo, hi) in ranges.items()],
                                 f"{series} string, low double, high double")
    src = bronze.filter(F.col(series).isin(list(ranges)))
    has_v, has_p, has_s = "value" in cols, "period" in cols, "source" in cols
    keys = [series] + (["period"] if has_p else [])
    first = [F.count(F.lit(1)).alias("n")]
    if has_v:
        v = F.col("value").cast("double") if dict(bronze.dtypes)["value"] != "string" else parse_number("value")
        first += [_n(v.isNull()).alias("null_value"), F.min(v).alias("lo"), F.max(v).alias("hi")]
    if has_s:
        first.append(_n(F.col("source").isNull()).alias("null_source"))
    groups = src.groupBy(*keys).agg(*first)
    second = [_total("n")]
    if has_v:
        second += [_total("null_value"), F.min("lo").alias("lo"), F.max("hi").alias("hi")]
    if has_p:
        second += [F.coalesce(F.sum(F.when(F.col("period").isNull(), F.col("n"))), F.lit(0)).cast("long").alias("null_period"),
                   F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("dupes")]
    if has_s:
        second.append(_total("null_source"))
    found = groups.groupBy(series).agg(*second)
    one = spec.join(found, series, "left").fillna(0, [c for c in found.columns if c not in (series, "lo", "hi")])

    checks: list[tuple[str, Column]] = [
        ("table_not_empty", F.col("n") > 0),
        ("has_value_column", F.lit(has_v)),
        ("has_period_column", F.lit(has_p)),
    ]
    if has_v:
        checks += [("value_no_nulls", _zero("null_value")),
                   ("value_in_range", F.coalesce((F.col("lo") >= F.col("low")) & (F.col("hi") <= F.col("high")), F.lit(True))),
                   ("value_has_variance", F.coalesce(F.col("lo") < F.col("hi"), F.lit(False)))]
    if has_p:
        checks += [("period_no_nulls", _zero("null_period")), ("period_no_duplicates", _zero("dupes"))]
    if has_s:
        checks.append(("source_tag_present", _zero("null_source")))
    packed = F.array(*[F.struct(F.lit(name).alias("expectation"), ok.alias("passed")) for name, ok in checks])
    return one.select(F.concat(F.col(series), F.lit("_suite")).alias("suite"), F.explode(packed).alias("c")).select("suite", "c.*")


def suite_totals(results: DataFrame) -> DataFrame:
    """Totals and success rate per suite."""
    t = results.groupBy("suite").agg(
        F.count(F.lit(1)).cast("long").alias("total_expectations"),
        F.sum(F.col("passed").cast("long")).alias("passed"))
    return t.select("suite", "total_expectations", "passed",
                    (F.col("total_expectations") - F.col("passed")).alias("failed"),
                    F.round(F.col("passed") / F.col("total_expectations") * 100, 2).alias("success_rate"),
                    (F.col("passed") == F.col("total_expectations")).alias("is_passing"))


def suite_summary(results: DataFrame) -> DataFrame:
    """One text line per expectation, as a report prints them."""
    mark = F.when(F.col("passed"), F.lit("PASS")).otherwise(F.lit("FAIL"))
    return results.select("suite", F.concat_ws(" ", mark, F.col("expectation"), F.lit("-"), F.col("details")).alias("line"))


def quality_gate(totals: DataFrame, min_rate: float = MIN_GATE_RATE) -> DataFrame:
    """One row: does every suite reach the least success rate?"""
    return totals.agg(F.min("success_rate").alias("lowest_rate"),
                      F.coalesce(F.min(F.col("success_rate") >= min_rate), F.lit(False)).alias("gate_passed"))


def column_tests(df: DataFrame, not_null: Sequence[str] = (), unique: Sequence[str] = (),
                 accepted: Mapping[str, Sequence] | None = None) -> DataFrame:
    """Declared column tests as rows ``(test_name, column_name, n_failures, passed)``.

    ``unique`` counts the values that occur more than once; NULL values are not compared. All unique columns share one aggregate over
    (column, value) and all other tests another, so the number of shuffles does not depend on the number of tests.
    """
    accepted = accepted or {}
    wanted = [("not_null", c) for c in not_null] + [("accepted_values", c) for c in accepted] + [("unique", c) for c in unique]
    df = stage(df.select(*dict.fromkeys([*not_null, *unique, *accepted])), "column-tests")  # both aggregates read what was computed once
    fails = {("not_null", c): F.col(c).isNull() for c in not_null}
    fails |= {("accepted_values", c): F.col(c).isNotNull() & ~F.col(c).isin(list(v)) for c, v in accepted.items()}
    found = []
    if fails:
        one = df.agg(*[F.coalesce(F.sum(bad.cast("long")), F.lit(0)).alias(f"n{i}") for i, bad in enumerate(fails.values())])
        rows = [F.struct(F.lit(t).alias("test_name"), F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n_failures")) for i, (t, c) in enumerate(fails)]
        found.append(one.select(F.explode(F.array(*rows)).alias("t")).select("t.*"))
    if unique:
        cells = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in unique])).alias("c")).select("c.*")
        often = cells.filter(F.col("v").isNotNull()).groupBy("column_name", "v").count().filter("count > 1").groupBy("column_name").agg(F.count(F.lit(1)).alias("n_failures"))
        found.append(often.select(F.lit("unique").alias("test_name"), "column_name", "n_failures"))
    asked = df.sparkSession.createDataFrame(wanted, "test_name string, column_name string").coalesce(1)
    seen = reduce(DataFrame.unionByName, found)
    out = asked.join(F.broadcast(seen), ["test_name", "column_name"], "left")  # a row per test at most
    return out.select("test_name", "column_name", F.coalesce("n_failures", F.lit(0)).cast("long").alias("n_failures"),
                      (F.coalesce("n_failures", F.lit(0)) == 0).alias("passed"))

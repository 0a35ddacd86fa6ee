"""Per-series statistics over month cells, correlation, profiles and outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthgrid.functions.scalars import round_half_up
from monthgrid.functions.windows import ordered, whole


def iqr_bounds(cells: DataFrame, by: str = "series", c: str = "value", k: float = 3.0) -> DataFrame:
    """Exact quartiles (linear interpolation) and the outlier fence of each series.

    Exact percentiles keep a group's distinct values in memory; a group here is one series of
    month cells, bounded by the calendar. For raw rows use ``approx_quartiles``.
    """
    q = cells.groupBy(by).agg(F.percentile(c, 0.25).alias("q1"), F.percentile(c, 0.75).alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    return q.select(by, "q1", "q3", (F.col("q1") - k * iqr).alias("lower"), (F.col("q3") + k * iqr).alias("upper"))


def approx_quartiles(rows: DataFrame, by: str, c: str = "value", accuracy: int = 10000) -> DataFrame:
    """Mergeable quantile sketch for unbounded groups of raw rows."""
    return rows.groupBy(by).agg(F.percentile_approx(c, [0.25, 0.5, 0.75], accuracy).alias("quartiles"))


def flag_iqr_outliers(cells: DataFrame, by: str = "series", c: str = "value", k: float = 3.0) -> DataFrame:
    """Add ``q1``, ``q3``, ``is_outlier`` per series, on the partitioning the series windows use."""
    w = whole(by)
    out = cells.withColumn("q1", F.percentile(c, 0.25).over(w)).withColumn("q3", F.percentile(c, 0.75).over(w))
    iqr = F.col("q3") - F.col("q1")
    outside = (F.col(c) < F.col("q1") - k * iqr) | (F.col(c) > F.col("q3") + k * iqr)
    return out.withColumn("is_outlier", F.coalesce(outside, F.lit(False)))


def profile(cells: DataFrame, by: str = "series") -> DataFrame:
    """Count, min, max, mean, deviation and latest value of each series."""
    present = cells.filter(F.col("value").isNotNull())
    return present.groupBy(by).agg(
        F.count("value").alias("n"),
        F.min("value").alias("min_value"), F.max("value").alias("max_value"),
        round_half_up(F.avg("value")).alias("mean_value"),
        round_half_up(F.stddev_samp("value")).alias("std_value"),
        F.max_by("value", "period").alias("latest_value"),
        F.max("period").alias("latest_period"))


def correlate_with_targets(cells: DataFrame, targets: Sequence[str], by: str = "series",
                           strong: float = 0.5) -> DataFrame:
    """Pearson correlation of every series with each target, over the months both have.

    The targets become columns of one row per month (bounded by the calendar), so each cell
    meets one row instead of every other series of its month.
    """
    side = cells.filter(F.col(by).isin(list(targets))).groupBy("period").pivot(by, list(targets)).agg(F.first("value"))
    joined = cells.join(side, "period")
    wide = joined.groupBy(by).agg(*[F.corr("value", F.col(f"`{t}`")).alias(t) for t in targets],
                                  *[F.sum((F.col("value").isNotNull() & F.col(f"`{t}`").isNotNull()).cast("long")).alias(f"_n_{t}")
                                    for t in targets])
    pairs = F.explode(F.array(*[
        F.struct(F.lit(t).alias("target"), F.col(f"`{t}`").alias("r"), F.col(f"_n_{t}").alias("n_pairs")) for t in targets]))
    out = wide.select(F.col(by).alias("feature"), pairs.alias("p")).select("feature", "p.*")
    r = F.col("r")
    return out.select(
        "feature", "target", "n_pairs", round_half_up(r).alias("corr"),
        F.when(F.abs(r) > strong, F.lit("strong")).otherwise(F.lit("weak")).alias("strength"),
        F.when(r > 0, F.lit("positive")).otherwise(F.lit("negative")).alias("direction"))


def percent_rank_of_latest(cells: DataFrame, by: str = "series", high: float = 90.0, low: float = 10.0) -> DataFrame:
    """Share of a series' history strictly below its latest value, in percent, with its band."""
    present = cells.filter(F.col("value").isNotNull())
    newest = F.max_by("value", "period").over(whole(by))
    marked = present.withColumn("latest_value", newest)
    rank = F.avg(F.when(F.col("value") < F.col("latest_value"), 1.0).otherwise(0.0)) * 100
    out = marked.groupBy(by).agg(F.first("latest_value").alias("latest_value"), rank.alias("p"))
    band = F.when(F.col("p") > high, "top").when(F.col("p") < low, "bottom").otherwise("normal")
    return out.select(by, "latest_value", round_half_up("p").alias("pct_rank"), band.alias("band"))


def latest_and_delta(cells: DataFrame, by: str = "series") -> DataFrame:
    """Latest value, its change and percent change against the previous value present."""
    present = cells.filter(F.col("value").isNotNull())
    prev = present.withColumn("prev", F.lag("value").over(ordered(by)))
    last = prev.groupBy(by).agg(F.max("period").alias("latest_period"),
                                F.max_by(F.struct("value", "prev"), "period").alias("m"))
    delta: Column = F.col("m.value") - F.col("m.prev")
    return last.select(by, "latest_period", F.col("m.value").alias("latest_value"),
                       round_half_up(delta).alias("delta"),
                       round_half_up(delta / F.nullif(F.col("m.prev"), F.lit(0.0)) * 100).alias("delta_pct"))


def seasonal_means(cells: DataFrame, by: str = "series") -> DataFrame:
    """Mean per month of the year."""
    present = cells.filter(F.col("value").isNotNull())
    return present.groupBy(by, F.month("period").alias("month")).agg(round_half_up(F.avg("value")).alias("mean_value"))


def year_overlay(cells: DataFrame, by: str = "series", min_months: int = 6) -> DataFrame:
    """One line per year over the months, for years with at least ``min_months`` values."""
    present = cells.filter(F.col("value").isNotNull()).select(
        by, F.year("period").alias("year"), F.month("period").alias("month"), "value")
    n = F.count(F.lit(1)).over(whole([by, "year"]))
    return present.withColumn("_n", n).filter(F.col("_n") >= min_months).drop("_n")


def provider_counts(obs: DataFrame, approximate: bool = False) -> DataFrame:
    """Rows, series and days per provider.

    Exact counts first reduce to (provider, series, day), so distinct sets stay small and no task
    holds a provider; the approximate form keeps one sketch per provider instead.
    """
    if approximate:
        return obs.groupBy("provider").agg(
            F.count(F.lit(1)).alias("n_rows"), F.approx_count_distinct("series_id").alias("n_series"),
            F.approx_count_distinct("period").alias("n_days"))
    days = obs.groupBy("provider", "series_id", "period").agg(F.count(F.lit(1)).alias("n"))
    return days.groupBy("provider").agg(F.sum("n").alias("n_rows"), F.countDistinct("series_id").alias("n_series"),
                                        F.countDistinct("period").alias("n_days"))

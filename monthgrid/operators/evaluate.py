"""Scoring forecasts: error metrics, model comparison, leaderboards, backtest splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from monthgrid.functions.scalars import round_half_up
from monthgrid.functions.windows import ordered, whole

METRICS = ("rmse", "mae", "mape", "r2")


def error_metrics(scored: DataFrame, by: Sequence[str], actual: str = "actual", predicted: str = "forecast_value") -> DataFrame:
    """RMSE, MAE, MAPE, R2 and count per group, over rows that have both values.

    MAPE leaves out zero actuals and is 0 when none is left; R2 is 0 when the actuals are constant.
    Everything is a mergeable sum, so nothing but one row per group leaves a task.
    """
    a, e = F.col(actual), F.col(actual) - F.col(predicted)
    both = scored.filter(a.isNotNull() & F.col(predicted).isNotNull())
    g = both.groupBy(*by).agg(
        F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        (F.avg(F.when(a != 0, F.abs(e / F.nullif(a, F.lit(0.0))))) * 100).alias("mape"),
        F.sum(e * e).alias("_res"), F.var_pop(a).alias("_var"), F.count(F.lit(1)).alias("n_periods"))
    r2 = F.when(F.col("_var") > 0, 1 - F.col("_res") / (F.col("_var") * F.col("n_periods"))).otherwise(F.lit(0.0))
    return g.select(*by, round_half_up("rmse").alias("rmse"), round_half_up("mae").alias("mae"),
                    round_half_up(F.coalesce("mape", F.lit(0.0))).alias("mape"), round_half_up(r2).alias("r2"), "n_periods")


def align(actuals: DataFrame, forecasts: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Forecasts with their actual value; ``left`` keeps forecasts of months not seen yet."""
    return forecasts.join(actuals, list(on), how)


def best_flags(metrics: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mark the best value of each metric within a group; ties are all marked."""
    w = W.partitionBy(*by)
    return (metrics.withColumn("best_rmse", F.col("rmse") == F.min("rmse").over(w))
            .withColumn("best_mape", F.col("mape") == F.min("mape").over(w))
            .withColumn("best_r2", F.col("r2") == F.max("r2").over(w)))


def leaderboard(rows: DataFrame, within: Sequence[str] = ("window",), model: str = "model_label") -> DataFrame:
    """First metrics of each model by month, ranked by MAPE within each group, unknown ones last."""
    g = rows.groupBy(*within, model).agg(F.min_by("rmse", "forecast_period").alias("rmse"), F.min_by("mape", "forecast_period").alias("mape"),
                                         F.count("forecast_period").alias("n_months"))
    return ranked(g, within)


def best_config(scored: DataFrame, by: Sequence[str], config: str = "config", metric: str = "mape") -> DataFrame:
    """The configuration with the least error per group; ties go to the smaller name."""
    return scored.filter(F.col(metric).isNotNull()).groupBy(*by).agg(
        F.min_by(config, F.struct(metric, config)).alias(config), F.min(metric).alias(metric))


def chronological_split(df: DataFrame, by: str, test_size: float = 0.2, order: str = "period") -> DataFrame:
    """Add ``split``: the first ``int(n * (1 - test_size))`` rows of a series train, the rest test."""
    pos = F.row_number().over(ordered(by, order))
    # same rounding as binary floating point n * (1 - test_size), truncated
    cut = F.floor(F.count(F.lit(1)).over(whole(by)) * F.lit(1 - test_size))
    return df.withColumn("split", F.when(pos <= cut, F.lit("train")).otherwise(F.lit("test")))


def backtest_frame(df: DataFrame, by: str, n_splits: int = 3, horizon: int = 12, min_train: int = 24,
                   order: str = "period") -> DataFrame:
    """Rows of each expanding-window split: ``(…, split, role)`` with role ``train`` or ``test``.

    Each row lists the splits it belongs to and is exploded over them, so there is no theta join.
    Series too short for the splits carry split 0 with role ``too_short``.
    """
    n = F.count(F.lit(1)).over(whole(by))
    numbered = df.withColumn("_i", F.row_number().over(ordered(by, order)) - 1).withColumn("_n", n)
    base = F.col("_n") - F.lit(n_splits * horizon)

    def end(i: int):
        return base + F.lit(i * horizon)

    def part(i: int):
        role = (F.when(F.col("_i") < end(i), F.lit("train"))
                .when(F.col("_i") < end(i) + horizon, F.lit("test")))
        return F.struct(F.lit(i + 1).alias("split"), role.alias("role"))

    parts = F.filter(F.array(*[part(i) for i in range(n_splits)]), lambda p: p["role"].isNotNull())
    short = F.array(F.struct(F.lit(0).alias("split"), F.lit("too_short").alias("role")))
    chosen = F.when(base < min_train, short).otherwise(parts)
    return numbered.withColumn("_s", F.explode(chosen)).select(*df.columns, "_s.split", "_s.role")


def variant_gap(a: DataFrame, b: DataFrame, keys: Sequence[str], small: float = 2.0, moderate: float = 6.0) -> DataFrame:
    """How much worse variant B is than A in MAPE points, with a verdict."""
    j = a.select(*keys, F.col("mape").alias("mape_a")).join(b.select(*keys, F.col("mape").alias("mape_b")), list(keys))
    gap = F.col("mape_b") - F.col("mape_a")
    verdict = F.when(gap < small, "small").when(gap < moderate, "moderate").otherwise("large")
    return j.select(*keys, "mape_a", "mape_b", round_half_up(gap).alias("gap_pp"), verdict.alias("verdict"))


def ranked(metrics: DataFrame, by: Sequence[str], error: str = "mape") -> DataFrame:
    """Adds ``place``: the rank by ``error`` within each group, smallest first; rows without an error measure share the last place."""
    return metrics.withColumn("place", F.rank().over(W.partitionBy(*by).orderBy(F.col(error).asc_nulls_last())))

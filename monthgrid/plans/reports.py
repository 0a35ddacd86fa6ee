"""Reporting shapes over forecasts, features and run logs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthgrid.functions.scalars import map_label, round_half_up
from monthgrid.operators.cells import pivot_cells

# Group of each base series, for importances and catalog pages.
FEATURE_GROUPS = {
    "wti_price": "Petroleum", "brent_price": "Petroleum", "oil_production": "Petroleum", "crude_imports": "Petroleum",
    "refinery_util": "Petroleum", "gasoline_stocks": "Petroleum", "distillate_stocks": "Petroleum",
    "henry_hub_price": "Natural Gas", "gas_storage": "Natural Gas", "gas_production": "Natural Gas",
    "hdd": "Weather", "cdd": "Weather", "opec_spare": "Supply", "global_inv": "Supply",
    "dollar_index": "Macro", "industrial_production": "Macro", "treasury_10y": "Macro",
}


def seasonal_naive_forecasts(features: DataFrame, windows: Sequence[tuple[int, int]]) -> DataFrame:
    """Three model-free forecasts per target and month of each test year.

    ``features`` has ``(period, series, value, lag_1, lag_12, roll12_mean)``; ``windows`` lists
    (test year, training months). They give the scoring operators exact inputs.
    """
    models = F.explode(F.array(
        F.struct(F.lit("seasonal_naive").alias("model_name"), F.col("lag_12").alias("forecast_value")),
        F.struct(F.lit("trailing_mean").alias("model_name"), F.col("roll12_mean").alias("forecast_value")),
        F.struct(F.lit("last_value").alias("model_name"), F.col("lag_1").alias("forecast_value"))))
    trained = map_label(F.year("period"), {y: n for y, n in windows})
    return (features.withColumn("trained_on_periods", trained).filter(F.col("trained_on_periods").isNotNull())
            .select(F.col("series").alias("target"), F.col("period").alias("forecast_period"), "trained_on_periods",
                    F.col("value").alias("actual"), models.alias("m"))
            .select("target", "m.model_name", "forecast_period", "m.forecast_value", "trained_on_periods", "actual"))


def forecast_pivot(forecasts: DataFrame, models: Sequence[str], index: Sequence[str] = ("target", "forecast_period")) -> DataFrame:
    """Forecasts side by side with the actual value and each model's error, two decimals."""
    wide = pivot_cells(forecasts.withColumnRenamed("forecast_value", "value"), models, "model_name", "avg", index)
    actual = forecasts.groupBy(*index).agg(F.max("actual").alias("actual"))
    j = wide.join(actual, list(index))
    return j.select(*index, round_half_up("actual", 2).alias("actual"),
                    *[round_half_up(m, 2).alias(m) for m in models],
                    *[round_half_up(F.col(m) - F.col("actual"), 2).alias(f"error_{m}") for m in models])


def forecast_view(forecasts: DataFrame, actual_until: DataFrame, validation_year: int) -> DataFrame:
    """Future (after the last actual month) and validation forecasts, each summarised per model."""
    j = forecasts.join(actual_until, "target")
    view = (F.when(F.col("forecast_period") > F.col("last_actual"), F.lit("Future"))
            .when(F.year("forecast_period") == validation_year, F.lit("Validation")))
    seen = j.withColumn("view", view).filter(F.col("view").isNotNull())
    return seen.groupBy("target", "model_name", "view").agg(
        F.count(F.lit(1)).alias("n_months"),
        round_half_up(F.min_by("forecast_value", "forecast_period")).alias("first_value"),
        round_half_up(F.max_by("forecast_value", "forecast_period")).alias("last_value"),
        round_half_up(F.avg("forecast_value")).alias("avg_value"))


def importance_groups(importances: DataFrame, groups: Mapping[str, str] = FEATURE_GROUPS) -> DataFrame:
    """Summed importance per feature group of each target."""
    named = importances.withColumn("feature_group", F.coalesce(map_label("feature", groups), F.lit("Other")))
    return named.groupBy("target", "feature_group").agg(round_half_up(F.sum("importance")).alias("importance"))


def run_success_rate(runs: DataFrame, last: int, *order) -> DataFrame:
    """Share of successful runs among the newest ``last``."""
    recent = runs.orderBy(*order).limit(last)
    ok = F.sum((F.col("status") == "success").cast("long"))
    return recent.agg(F.count(F.lit(1)).alias("n_runs"), ok.alias("n_success"),
                      F.round(ok / F.nullif(F.count(F.lit(1)), F.lit(0)) * 100, 2).alias("success_rate"))


def layer_row(df: DataFrame, layer: str, period: str = "period") -> DataFrame:
    return df.agg(F.max(period).alias("latest_period"), F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(layer).alias("layer"), "latest_period", "n_rows")


def latest_per_feature(cells: DataFrame, by: str = "series") -> DataFrame:
    """Latest value present per feature with its group."""
    last = cells.filter(F.col("value").isNotNull()).groupBy(by).agg(
        F.max("period").alias("latest_period"), F.max_by("value", "period").alias("latest_value"))
    return last.withColumn("feature_group", F.coalesce(map_label(by, FEATURE_GROUPS), F.lit("Other")))


def reindex(df: DataFrame, keys: DataFrame, on: Sequence[str], drop_missing: bool = False) -> DataFrame:
    """Rows of ``df`` in the shape of a key list; absent keys give NULL rows or are dropped."""
    return keys.join(df, list(on), "inner" if drop_missing else "left")

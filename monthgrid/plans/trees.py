"""Boosted trees: one pooled model over all series, trained by Spark on feature rows.

Inputs are the leak-free measures, put on one scale by dividing with the series' trailing yearly
mean, so that one model serves every series and training is spread over rows, not over series.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthgrid.functions.scalars import month_cos, month_sin, round_half_up
from monthgrid.operators.evaluate import best_config, error_metrics

SCALED = ["lag_1", "lag_3", "lag_6", "lag_12", "roll3_mean", "roll6_mean"]
FEATURES = [*SCALED, "mom_pct", "vs_12mo_avg", "month_sin", "month_cos"]


@dataclass(frozen=True)
class TreeConfig:
    """Booster settings. ``extra`` holds what stands in for L1 and L2 weights, which Spark's trees lack."""

    label: str = "baseline"
    trees: int = 300
    depth: int = 4
    rate: float = 0.05
    subsample: float = 0.8
    columns: float = 0.8
    seed: int = 42
    extra: dict = field(default_factory=dict, hash=False)


# The swept settings. A light L1 becomes a least gain, a heavy L2 a least leaf size.
SWEEP = [
    TreeConfig("baseline"),
    TreeConfig("depth 3", depth=3),
    TreeConfig("depth 2", depth=2),
    TreeConfig("depth 3, light L1", depth=3, extra={"minInfoGain": 1e-5}),
    TreeConfig("depth 3, heavy L2", depth=3, extra={"minInstancesPerNode": 5}),
    TreeConfig("depth 3, both", depth=3, extra={"minInfoGain": 1e-5, "minInstancesPerNode": 5}),
    TreeConfig("more trees, slower", trees=500, depth=3, rate=0.03),
    TreeConfig("fewer trees", trees=100, depth=3),
]


def training_rows(strict: DataFrame) -> DataFrame:
    """``(series, period, value, scale, label, features)`` from strict measures; incomplete rows drop out."""
    s = F.col("roll12_mean")
    scaled = [(F.col(c) / F.nullif(s, F.lit(0.0))).alias(c) for c in SCALED]
    rows = strict.select(
        "series", "period", "value", s.alias("scale"), (F.col("value") / F.nullif(s, F.lit(0.0))).alias("label"), *scaled, "mom_pct",
        (F.col("vs_12mo_avg") / F.nullif(s, F.lit(0.0))).alias("vs_12mo_avg"),
        month_sin("period").alias("month_sin"), month_cos("period").alias("month_cos")).dropna(subset=FEATURES)
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows).select(
        "series", "period", "value", "scale", "label", "features")


def wide_rows(wide: DataFrame, target: str, features: Sequence[str]) -> DataFrame:
    """Rows of one target from a wide feature table, in its own units, for a model of that target alone."""
    rows = wide.dropna(subset=[*features, target]).withColumn("series", F.lit(target)).withColumn("value", F.col(target))
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(rows).select(
        "series", "period", "value", F.lit(1.0).alias("scale"), F.col("value").alias("label"), "features")


def fit_trees(rows: DataFrame, config: TreeConfig = TreeConfig()) -> GBTRegressionModel:
    gbt = GBTRegressor(maxIter=config.trees, maxDepth=config.depth, stepSize=config.rate, subsamplingRate=config.subsample,
                       featureSubsetStrategy=str(config.columns), seed=config.seed, **config.extra)
    return gbt.fit(rows.filter(F.col("label").isNotNull()))


def predict_trees(model: GBTRegressionModel, rows: DataFrame, name: str) -> DataFrame:
    """``(series, period, value, config, forecast)``, back in the series' units."""
    p = model.transform(rows)
    return p.select("series", "period", "value", F.lit(name).alias("config"), round_half_up(F.col("prediction") * F.col("scale")).alias("forecast"))


def importances(model: GBTRegressionModel, spark, features: Sequence[str] = tuple(FEATURES)) -> DataFrame:
    """``(feature, importance)``; one row per input column, a fixed list."""
    values = [float(v) for v in model.featureImportances.toArray()]
    return spark.createDataFrame(list(zip(features, values)), "feature string, importance double")


def sweep(train: DataFrame, check: DataFrame, configs: Sequence[TreeConfig] = tuple(SWEEP), by: Sequence[str] = (),
          parallel: int = 4) -> DataFrame:
    """Metrics of every setting on a validation stretch between the training and the test months.

    The settings are few and each fit is a distributed job; a few are submitted at a time.
    """
    with ThreadPool(parallel) as pool:
        models = pool.map(lambda c: fit_trees(train, c), list(configs))
    scored = reduce(DataFrame.unionByName, [predict_trees(m, check, c.label) for m, c in zip(models, configs)])
    return error_metrics(scored, [*by, "config"], "value", "forecast")


def chosen(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return best_config(scores, list(by))


def between(df: DataFrame, start: str, end: str) -> DataFrame:
    p: Column = F.col("period")
    return df.filter(p.between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))

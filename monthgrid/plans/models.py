"""Fitted models kept by name, target and date, in versions."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.ml.regression import GBTRegressionModel
from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthgrid.sinks.tables import VersionedTable

_INDEX = "name string, target string, on date, version int, kind string, path string"
#: How models of each kind are loaded again; a table of model rows is a frame.
_LOADERS = {"rows": lambda spark, path: spark.read.parquet(path), "GBTRegressionModel": lambda spark, path: GBTRegressionModel.load(path)}


class ModelRegistry:
    """Tables of model rows and Spark ML models below one folder.

    A model is written to a folder of its own and then listed in the index, which is swapped in one step: a model that is listed is
    complete. Saving the same name, target and date again makes a new version and leaves the old one as it is.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self._index = spark, folder, VersionedTable(spark, f"{folder}/index")

    def models(self) -> DataFrame:
        """(name, target, on, version, kind, path) of all models."""
        known = self._index.read()
        return self.spark.createDataFrame([], _INDEX) if known is None else known

    def save(self, model: DataFrame | MLWritable, name: str, target: str, on: dt.date) -> int:
        """Write a model and return its version."""
        kind = "rows" if isinstance(model, DataFrame) else type(model).__name__
        if kind not in _LOADERS:
            raise ValueError(f"models of kind {kind} cannot be kept")
        path = f"{self.folder}/models/{uuid.uuid4().hex}"
        if kind == "rows":
            model.write.mode("errorifexists").parquet(path)
        else:
            model.write().save(path)
        known = self.models()
        same = known.filter((F.col("name") == name) & (F.col("target") == target) & (F.col("on") == F.lit(on)))
        version = (same.agg(F.max("version")).first()[0] or 0) + 1
        row = self.spark.createDataFrame([(name, target, on, version, kind, path)], _INDEX)
        self._index.swap(known.unionByName(row).coalesce(1))
        return version

    def load(self, name: str, target: str, on: dt.date | None = None, version: int | None = None) -> DataFrame | GBTRegressionModel:
        """The model of a name and target: of the newest date and version unless these are given."""
        found = self.models().filter((F.col("name") == name) & (F.col("target") == target))
        if on is not None:
            found = found.filter(F.col("on") == F.lit(on))
        if version is not None:
            found = found.filter(F.col("version") == version)
        row = found.orderBy(F.desc("on"), F.desc("version")).first()
        if row is None:
            raise LookupError(f"no model {name!r} for {target!r}")
        return _LOADERS[row["kind"]](self.spark, row["path"])

"""Silver and gold as stored tables, partitioned by year and kept up to date load by load.

Raw observations are read once, when they land: a load is reduced to its latest value per series and month and merged into a keyed
table of cells, newest load first. Silver and gold are computed from the cells, which are as many as series times months, and only the
years in which a row has changed are written again: a late row of 1998 rewrites 1998, the following months that look back on it, and
what its series' outlier bounds move.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthgrid.catalog import Domain
from monthgrid.operators.cells import clean, latest_cells
from monthgrid.plans.medallion import gold, silver_from_cells
from monthgrid.sinks.tables import truncate_load
from monthgrid.sources.reads import between_periods
from monthgrid.streaming.keyed import KeyedTable

CELLS = T.StructType([T.StructField("series_id", T.StringType()), T.StructField("period", T.DateType()), T.StructField("value", T.DoubleType()),
                      T.StructField("ingested_at", T.TimestampType())])


def read_range(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows of an inclusive date range of a table partitioned by year; only the folders of its years are listed and read."""
    rows = spark.read.parquet(path)
    if start is not None:
        rows = rows.filter(F.col("year") >= int(start[:4]))
    if end is not None:
        rows = rows.filter(F.col("year") <= int(end[:4]))
    return between_periods(rows, start, end).drop("year")


def rewrite_changed(new: DataFrame, path: str) -> list[int]:
    """Make the table at ``path`` equal to ``new``, keyed by ``period``, writing only the years that differ; returns them.

    Rows are compared whole, NULL equal to NULL. A year whose rows are all gone is not removed, as periods never disappear.
    """
    spark, columns = new.sparkSession, new.columns
    new = new.withColumn("year", F.year("period"))
    try:
        old = spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e.getCondition()):
            raise
        truncate_load(new, path, "year")
        return sorted(r[0] for r in new.select("year").distinct().collect())
    both = new.select("year", F.struct(*columns).alias("row"), F.lit(1).alias("side")).unionByName(
        old.select("year", F.struct(*columns).alias("row"), F.lit(-1).alias("side")))
    apart = both.groupBy("year", "row").agg(F.sum("side").alias("n")).filter("n <> 0").select("year").distinct()
    years = sorted(r[0] for r in apart.collect())  # at most the years of the calendar
    if years:
        truncate_load(new.filter(F.col("year").isin(years)).coalesce(1), path, "year")
    return years


class StoredDomain:
    """One domain: its cells, and its silver table."""

    def __init__(self, spark: SparkSession, folder: str, domain: Domain):
        self.spark, self.folder, self.domain = spark, folder, domain
        self.cells = KeyedTable(spark, f"{folder}/cells", CELLS, ["series_id", "period"], order=["ingested_at", "value"], by="period")

    def load(self, obs: DataFrame, number: int) -> list[int]:
        """Take in a load of raw observations (numbered from 0; a repeated number changes nothing) and return the years of silver rewritten."""
        batch = latest_cells(clean(obs, self.domain.min_value), ["series_id"], stamp=True)
        self.cells.upsert(batch, number)
        return rewrite_changed(silver_from_cells(self.cells.read().select("series_id", "period", "value"), self.domain), f"{self.folder}/silver")

    def read(self, start: str | None = None, end: str | None = None) -> DataFrame:
        return read_range(self.spark, f"{self.folder}/silver", start, end)


class StoredMart:
    """The gold table of two stored domains."""

    def __init__(self, oil: StoredDomain, gas: StoredDomain, folder: str):
        self.oil, self.gas, self.folder = oil, gas, folder

    def refresh(self) -> list[int]:
        """Bring gold up to date with both silver tables; returns the years rewritten."""
        return rewrite_changed(gold(self.oil.read(), self.gas.read()), f"{self.folder}/gold")

    def read(self, start: str | None = None, end: str | None = None) -> DataFrame:
        return read_range(self.oil.spark, f"{self.folder}/gold", start, end)

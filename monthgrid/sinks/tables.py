"""Writes: append, truncate-and-load, replace by key, keyed update, typed tables, run logs.

Nothing is overwritten where it is read from: results go to a fresh path and the caller swaps.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthgrid.functions.scalars import round_half_up, stable_id


def append_bronze(df: DataFrame, path: str, partition: str = "provider") -> int:
    """Append rows and say how many; one directory per provider so that a provider's read prunes the rest.

    The count is observed while the rows are written, not by reading them again.
    """
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").partitionBy(partition).parquet(path)
    return seen.get["n"]


def truncate_load(df: DataFrame, path: str, partition: str = "provider") -> None:
    """Replace only the partitions present in ``df``; the others stay."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition).parquet(path))


def replace_by_key(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``existing`` without the keys found in ``new``, plus all of ``new``."""
    drop = new.select(*keys).distinct()
    return existing.join(drop, list(keys), "left_anti").unionByName(new)


def _files(spark: SparkSession, folder: str):
    """The file system of a folder, local or remote, and its path class."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(folder).getFileSystem(spark._jsc.hadoopConfiguration()), path


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder with all its files; one that is gone already is left as it is."""
    files, path = _files(spark, folder)
    files.delete(path(folder), True)


class VersionedTable:
    """A table that is replaced as a whole: each write is a new ``version=N`` folder, readers take the newest complete one.

    A failed write leaves an incomplete folder that no reader sees and the next write passes over, so the swap is one step.
    Listing goes through the file system the path names, local or remote.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _versions(self) -> list[tuple[int, bool]]:
        """(number, complete) of the version folders."""
        files, path = _files(self.spark, self.folder)
        if not files.exists(path(self.folder)):
            return []
        names = [s.getPath() for s in files.listStatus(path(self.folder)) if s.getPath().getName().startswith("version=")]
        return [(int(p.getName().split("=")[1]), files.exists(path(p, "_SUCCESS"))) for p in names]

    def read(self) -> DataFrame | None:
        """The current rows; None before the first write."""
        complete = [n for n, done in self._versions() if done]
        return self.spark.read.parquet(f"{self.folder}/version={max(complete)}") if complete else None

    def swap(self, df: DataFrame) -> int:
        """Write ``df`` as the new current version and return its number. ``df`` may be read from the current one."""
        number = max((n for n, _ in self._versions()), default=0) + 1
        df.write.mode("errorifexists").parquet(f"{self.folder}/version={number}")
        return number

    def replace(self, new: DataFrame, keys: Sequence[str]) -> int:
        """The current rows without the keys found in ``new``, plus all of ``new``, as the new version."""
        old = self.read()
        return self.swap(new if old is None else replace_by_key(old, new, keys))

    def prune(self, keep: int) -> None:
        """Delete all but the newest ``keep`` complete versions; readers of those go on undisturbed."""
        complete = sorted(n for n, done in self._versions() if done)
        for number in complete[:-keep]:
            delete_folder(self.spark, f"{self.folder}/version={number}")


def update_by_key(rows: DataFrame, updates: DataFrame, keys: Sequence[str], columns: Sequence[str],
                  when: Column) -> DataFrame:
    """Set ``columns`` from ``updates`` on rows that match the key and satisfy ``when``."""
    fresh = updates.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))
    joined = rows.join(fresh, list(keys), "left")
    apply = F.coalesce(F.col("_hit"), F.lit(False)) & when
    return joined.select(*[
        F.when(apply, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
        for c in rows.columns])


def overwrite_column(rows: DataFrame, source: DataFrame, key: str, column: str) -> DataFrame:
    """Take ``column`` from ``source`` (by key) in place of the one in ``rows``."""
    fresh = source.select(key, F.col(column).alias("_fresh"))
    return rows.join(fresh, key, "left").select(*[
        F.col("_fresh").alias(column) if c == column else F.col(c) for c in rows.columns])


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast to the table's column types in the table's order; NaN becomes NULL."""
    source = dict(df.dtypes)

    def cell(name: str, kind: str) -> Column:
        c = F.col(name)
        if source[name] in ("double", "float"):
            c = F.when(~F.isnan(c), c)
        return c.try_cast(kind).alias(name)

    return df.select(*[cell(n, k) for n, k in types.items()])


def round_trip_csv(df: DataFrame, path: str) -> DataFrame:
    """Write CSV parts with a header and read them back with the same schema (no inference)."""
    df.write.mode("errorifexists").option("header", True).csv(path)
    return df.sparkSession.read.schema(df.schema).option("header", True).csv(path)


def round_trip_parquet(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


RUN_SCHEMA = T.StructType([
    T.StructField("run_name", T.StringType()), T.StructField("status", T.StringType()), T.StructField("rows_ingested", T.LongType()),
    T.StructField("rows_failed", T.LongType()), T.StructField("error_message", T.StringType()), T.StructField("started_at", T.TimestampType())])


def run_records(runs: DataFrame) -> DataFrame:
    """Run-log rows of many runs: columns not given are 0 or NULL. The id depends on name, status and start, so it repeats on a retry."""
    zero = {"rows_ingested": F.lit(0), "rows_failed": F.lit(0)}
    row = runs.select(*[(F.col(f.name) if f.name in runs.columns else zero.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name) for f in RUN_SCHEMA])
    return row.withColumn("id", stable_id("run_name", "status", "started_at"))


def run_record(spark: SparkSession, run_name: str, status: str, rows_ingested: int = 0, rows_failed: int = 0,
               error_message: str | None = None, started_at=None) -> DataFrame:
    """One run-log row, to be appended; the id repeats on a retry."""
    return run_records(spark.createDataFrame([(run_name, status, rows_ingested, rows_failed, error_message, started_at)], RUN_SCHEMA))


class RunLog:
    """A log to which a record can be appended any number of times and is there once.

    Each record has a folder named by its id, and appending replaces that folder alone: a retried or doubled append writes the same
    record again, in whatever order, and other writers are not disturbed.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def append(self, records: DataFrame) -> None:
        """Add records (``run_record``, ``run_records``); of several with one id, one is kept."""
        once = records.groupBy("id").agg(F.min(F.struct(*RUN_SCHEMA.fieldNames())).alias("r")).select("r.*", "id")
        truncate_load(once, self.folder, "id")

    def read(self) -> DataFrame:
        """All records with their id; none before the first append."""
        schema = T.StructType([*RUN_SCHEMA.fields, T.StructField("id", T.StringType())])
        files, path = _files(self.spark, self.folder)
        if not files.exists(path(self.folder)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.folder)


def quality_log(totals: DataFrame) -> DataFrame:
    """Suite totals with the success rate in percent, two decimals; 0 when nothing was checked."""
    rate = F.when(F.col("total_expectations") > 0, F.col("passed") / F.col("total_expectations") * 100)
    return totals.withColumn("success_rate", round_half_up(F.coalesce(rate, F.lit(0.0)), 2))


def backfill_runs(counts: DataFrame, run_of: Column, logged: DataFrame) -> DataFrame:
    """Run-log rows for loads never logged, from actual row counts per series."""
    rows = (counts.withColumn("run_name", run_of).filter(F.col("run_name").isNotNull())
            .groupBy("run_name").agg(F.sum("n_rows").cast("long").alias("rows_ingested"),
                                     F.count(F.lit(1)).cast("long").alias("n_tables")))
    return rows.join(logged.select("run_name").distinct(), "run_name", "left_anti").select(
        "run_name", F.lit("success").alias("status"), "rows_ingested", F.lit(0).cast("long").alias("rows_failed"),
        "n_tables")

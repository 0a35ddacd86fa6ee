"""Session defaults and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int | str = 8, memory: str = "12g", shuffle_partitions: int = 8) -> SparkSession:
    """A single-JVM session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("monthgrid")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SQL_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can see: ``spark.checkpoint.dir`` of the session, or else its checkpoint folder.

    A session of one JVM that names neither gets a private folder. Anything with executors of its own must name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if base:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(base)
        return base
    if context.getCheckpointDir() is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="monthgrid-"))
    return context.getCheckpointDir()


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is ever overwritten in place."""
    return f"{shared_dir(spark)}/monthgrid/{label}-{uuid.uuid4().hex}"


#: Spark removes the shuffle files of a query when the query ends, not when the driver next collects its garbage.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of queries that run inside are removed when they end: what they wrote or returned is all that is read again."""
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a result that several later steps read, and read it back.

    A written table survives the loss of executors and cuts the lineage, which a cached or
    locally checkpointed frame does not. The shuffles that made it leave the disk.
    """
    path = new_path(df.sparkSession, label)
    with freed_shuffles(df.sparkSession):
        df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

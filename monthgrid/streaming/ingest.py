"""Incremental ingestion as Structured Streaming.

Landed files are read once each (the checkpoint remembers them); late days rewrite their month. Every state is keyed by an event
time with a watermark of 60 days, the tail the daily pull reads again, so it expires. Rows that come later than that are dropped by
a stateful operator, and counted (``late_rows``); ``payloads`` keeps them in a side table instead.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from monthgrid.session import new_path
from monthgrid.streaming.keyed import KeyedTable

WATERMARK = "60 days"


def landed(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files of ``path`` (a folder or one file) as a stream, each read once."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # written as a pattern, because a plain path must be a folder
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def _means(rows: DataFrame, series: str, at: str, value: str) -> DataFrame:
    if rows.isStreaming:
        rows = rows.withWatermark(at, WATERMARK)
    return (rows.groupBy(series, at).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean_value"))
            .select(series, F.col(at).cast("date").alias("period"), "n", "mean_value"))


def daily_means(stream: DataFrame, time: str = "ts", series: str = "series", value: str = "value") -> DataFrame:
    """Count and mean per series and day. Works on batch and stream alike."""
    return _means(stream.withColumn("_at", F.date_trunc("day", F.col(time).cast("timestamp"))), series, "_at", value)


def monthly_means(stream: DataFrame, time: str = "ts", series: str = "series", value: str = "value") -> DataFrame:
    """Mean per series and calendar month. The month's first day is the event time, so a month's state expires 60 days after the newest month began."""
    return _means(stream.withColumn("_at", F.date_trunc("month", F.col(time).cast("timestamp"))), series, "_at", value)


def exact_once(stream: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """Drop rows delivered twice within the watermark."""
    at = stream.withColumn(time, F.col(time).cast("timestamp"))
    if not stream.isStreaming:
        return at.dropDuplicates(list(keys))
    return at.withWatermark(time, WATERMARK).dropDuplicatesWithinWatermark(list(keys))


def run_once(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "update") -> list:
    """Process everything landed so far, then stop; the next run on the same checkpoint goes on from there. Returns the batches' progress."""
    query = (stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return list(query.recentProgress)


def late_rows(progress: list) -> int:
    """Rows that stateful operators have dropped because they came after the watermark."""
    return sum(op.numRowsDroppedByWatermark for p in progress for op in p.stateOperators)


def state_rows(progress: list) -> list[int]:
    """Rows held as state after each batch."""
    return [sum(op.numRowsTotal for op in p.stateOperators) for p in progress]


def stream_into_table(stream: DataFrame, label: str, schema: StructType, keys: Sequence[str], mode: str = "update",
                      folder: str | None = None, order: Sequence[str] = (), by: str | None = None) -> DataFrame:
    """Run a stream into a keyed table and return the table.

    Pass the same ``folder`` again to go on where the last run stopped.
    """
    base = folder or new_path(stream.sparkSession, label)
    table = KeyedTable(stream.sparkSession, f"{base}/table", schema, keys, order, by)
    run_once(stream, table.upsert, f"{base}/checkpoint", mode)
    return table.read()

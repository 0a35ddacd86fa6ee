"""Landed JSON payloads as a stream: days into a keyed table, everything else into side tables, all of it counted.

A landed line is a series id, a tab and the payload its API sent. Each line, and each entry of its list, gets one verdict:

* ``quarantined``: the payload cannot be read;
* ``empty``: it can be read and holds no entries (an error answer, an empty list);
* ``missing``: an entry without a usable date or value;
* ``late``: an entry older than the newest day of all earlier batches less the tail that daily pulls read again;
* ``kept``: any other entry; it goes into the table.

A batch is judged and written once, in folders by verdict; a repeated batch judges against the same newest day and rewrites the
same folders. The ledger has a row per batch in which the verdicts add up to what landed. No rows are held as streaming state.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthgrid.functions.scalars import parse_number, parse_period
from monthgrid.sources.payloads import CORRUPT, OBSERVATION_SCHEMA, RESPONSE_SCHEMA, parse_payload_text
from monthgrid.streaming.ingest import run_once
from monthgrid.streaming.keyed import KeyedTable

#: Days before the newest that a daily pull reads again.
TAIL_DAYS = 60
VERDICTS = ("kept", "late", "missing", "empty", "quarantined")
DAYS = T.StructType([T.StructField("series_id", T.StringType()), T.StructField("period", T.DateType()), T.StructField("value", T.DoubleType())])
LEDGER = T.StructType([T.StructField("batch", T.LongType()), T.StructField("landed", T.LongType()), *[T.StructField(v, T.LongType()) for v in VERDICTS],
                       T.StructField("newest", T.DateType())])
_JUDGED = T.StructType([*DAYS.fields, T.StructField("text", T.StringType())])


def lines(df: DataFrame, series: str = "series_id", text: str = "text") -> DataFrame:
    """Payloads as landed lines."""
    return df.select(F.concat_ws("\t", series, text).alias("value"))


def landed_lines(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Text files of ``path`` as a stream of lines, each file read once."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def entries(landed: DataFrame, schema: T.StructType = OBSERVATION_SCHEMA) -> DataFrame:
    """(series_id, period, value, text, verdict) of every entry and every line without entries; ``text`` is a quarantined line's.

    Both payload shapes are understood: ``schema`` names which. Works on a batch and on a stream.
    """
    shape = {OBSERVATION_SCHEMA: ("observations", "date"), RESPONSE_SCHEMA: ("response.data", "period")}[schema]
    parsed = parse_payload_text(landed.select(F.substring_index("value", "\t", 1).alias("series_id"), "value",
                                              F.expr("substr(value, instr(value, '\t') + 1)").alias("payload")), "payload", schema)
    each = parsed.select("series_id", "value", CORRUPT, F.explode_outer(shape[0]).alias("e"))
    period, number = parse_period(f"e.{shape[1]}"), parse_number("e.value")
    verdict = (F.when(F.col(CORRUPT).isNotNull() | ~F.col("value").contains("\t"), "quarantined").when(F.col("e").isNull(), "empty")
               .when(period.isNull() | number.isNull(), "missing").otherwise("kept"))
    return each.select("series_id", period.alias("period"), number.alias("value"), F.when(verdict == "quarantined", F.col("value")).alias("text"), verdict.alias("verdict"))


class PayloadTable:
    """The days of many series, the newest delivery winning, with their side tables below one folder."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType = OBSERVATION_SCHEMA, tail_days: int = TAIL_DAYS, merge_every: int = 8):
        self.spark, self.folder, self.schema, self.tail_days = spark, folder, schema, tail_days
        self.table = KeyedTable(spark, f"{folder}/days", DAYS, ["series_id", "period"], by="period", merge_every=merge_every)
        self.log = KeyedTable(spark, f"{folder}/ledger", LEDGER, ["batch"], merge_every=merge_every)

    def ingest(self, batch: DataFrame, batch_id: int) -> None:
        """Judge a batch of lines and write it; for ``foreachBatch``."""
        if batch_id <= self.log.last_batch():
            return  # all of it was written before the stream could say so
        newest = self.ledger().filter(F.col("batch") < batch_id).agg(F.max("newest")).first()[0]
        judged = entries(batch, self.schema)
        if newest is not None:
            late = (F.col("verdict") == "kept") & (F.col("period") < F.date_sub(F.lit(newest), self.tail_days))
            judged = judged.withColumn("verdict", F.when(late, "late").otherwise(F.col("verdict")))
        path, seen = f"{self.folder}/judged/batch={batch_id}", Observation()
        counts = [F.count(F.when(F.col("verdict") == v, 1)).alias(v) for v in VERDICTS]
        (judged.observe(seen, F.count(F.lit(1)).alias("landed"), *counts, F.max(F.when(F.col("verdict") == "kept", F.col("period"))).alias("newest"))
         .write.mode("overwrite").partitionBy("verdict").parquet(path))
        found = seen.get
        self.table.adopt(f"{path}/verdict=kept" if found["kept"] else None, batch_id)
        self.log.upsert(self.spark.createDataFrame([(batch_id, *[found[f] for f in LEDGER.fieldNames()[1:]])], LEDGER).coalesce(1), batch_id)

    def run(self, landed: DataFrame) -> list:
        """Ingest everything landed so far."""
        return run_once(landed, self.ingest, f"{self.folder}/checkpoint", "append")

    def side(self, verdict: str) -> DataFrame:
        """(series_id, period, value, text) of the rows with a verdict other than ``kept``, and their batch."""
        if verdict == "kept":
            raise ValueError("kept rows are in the table")
        try:
            found = self.spark.read.schema(_JUDGED).parquet(f"{self.folder}/judged/batch=*/verdict={verdict}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e.getCondition()):
                raise
            return self.spark.createDataFrame([], _JUDGED).withColumn("batch", F.lit(0).cast("long"))
        return found.withColumn("batch", F.regexp_extract(F.col("_metadata.file_path"), r"/batch=(\d+)/", 1).cast("long"))

    def ledger(self) -> DataFrame:
        """A row per batch: what landed, by verdict, and the newest day kept."""
        return self.log.read()

    def read(self, late: bool = False) -> DataFrame:
        """(series_id, period, value) of the days; with ``late``, days that came too late fill those the table lacks."""
        days = self.table.read()
        if not late:
            return days
        filled = self.side("late").groupBy("series_id", "period").agg(F.max_by("value", F.struct("batch", "value")).alias("value"))
        return days.withColumn("_late", F.lit(0)).unionByName(filled.withColumn("_late", F.lit(1))).groupBy("series_id", "period").agg(
            F.min_by("value", "_late").alias("value"))

"""Landed JSON payloads to bronze rows.

Two shapes: ``{"response": {"data": [{period, value, ...}]}}`` with monthly periods, and
``{"observations": [{date, value}]}`` with daily text values where ``.`` means missing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthgrid.functions.scalars import month_of, parse_number, parse_period, round_half_up

CORRUPT = "_corrupt_record"

RESPONSE_SCHEMA = T.StructType([
    T.StructField("response", T.StructType([
        T.StructField("data", T.ArrayType(T.StructType([
            T.StructField("period", T.StringType()),
            T.StructField("value", T.StringType()),
            T.StructField("series-description", T.StringType()),
        ]))),
    ])),
    T.StructField(CORRUPT, T.StringType()),
])

OBSERVATION_SCHEMA = T.StructType([
    T.StructField("observations", T.ArrayType(T.StructType([
        T.StructField("date", T.StringType()),
        T.StructField("value", T.StringType()),
    ]))),
    T.StructField(CORRUPT, T.StringType()),
])


def read_payload_files(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One row per payload file, its path in ``file``; an unreadable one fills ``_corrupt_record``."""
    texts = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    return parse_payload_text(texts, "value", schema).drop("value")


def parse_payload_text(df: DataFrame, text: str, schema: T.StructType) -> DataFrame:
    """Parse payload text held in a column (a landing table) into the payload's columns."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return df.withColumn("_p", F.from_json(text, schema, options)).select("*", "_p.*").drop("_p")


def split_corrupt(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable, quarantined): one bad payload never fails the others."""
    bad = F.col(CORRUPT).isNotNull()
    return payloads.filter(~bad).drop(CORRUPT), payloads.filter(bad)


def response_rows(payloads: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Monthly payloads to ``(*keep, period, value, raw_response)``.

    A missing key or an empty list gives no rows; rows without a period or a value are dropped.
    """
    rows = payloads.select(*keep, F.explode("response.data").alias("d"))
    return rows.select(
        *keep,
        parse_period("d.period").alias("period"),
        parse_number("d.value").alias("value"),
        F.to_json("d").alias("raw_response"),
    ).dropna(subset=["period", "value"])


def observation_rows(payloads: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Daily payloads to ``(*keep, period, value)`` days; ``.`` is dropped."""
    rows = payloads.select(*keep, F.explode("observations").alias("o"))
    return rows.select(
        *keep, parse_period("o.date").alias("period"), parse_number("o.value").alias("value"),
    ).dropna(subset=["period", "value"])


def monthly_mean(days: DataFrame, by: Sequence[str]) -> DataFrame:
    """Daily values to their month's mean, four decimals; summed map-side before the shuffle."""
    return (days.groupBy(*by, month_of("period").alias("period"))
            .agg(round_half_up(F.avg("value")).alias("value")))


def stamp(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """Add name, unit and provider from the catalog. No hint: a caller's catalog may hold millions of series."""
    return rows.join(catalog, "series_id", "left")


def catalog_frame(spark: SparkSession, entries: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Catalog entries ``(column, series_id, unit, provider)`` as a small frame."""
    return spark.createDataFrame(list(entries), "series_name string, series_id string, unit string, provider string")


def payload_text(period: Column, value: Column, description: Column) -> Column:
    """One monthly payload holding one row, as the API would send it."""
    entry = F.struct(period.alias("period"), value.alias("value"), description.alias("series-description"))
    return F.to_json(F.struct(F.struct(F.array(entry).alias("data")).alias("response")))


def observation_text(date: Column, value: Column) -> Column:
    entry = F.struct(date.alias("date"), value.alias("value"))
    return F.to_json(F.struct(F.array(entry).alias("observations")))

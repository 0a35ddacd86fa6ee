"""Bounded samples of labelled rows, shared by the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(n: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def labelled_sample(labels: DataFrame, target: str, limit: int, keep: Column | None = None) -> DataFrame:
    """(doc_id, label) of about ``limit`` rows with a label, chosen by a hash of the id; all of them if there are no more.

    A row without id or label is left out; an id with several labels takes the largest.
    """
    rows = labels.select("doc_id", F.col(target).alias("label")).filter("doc_id IS NOT NULL AND label IS NOT NULL")
    if keep is not None:
        rows = rows.filter(keep)
    total = rows.count()
    if total > limit:
        rows = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 30)) < int((1 << 30) * limit / total))
    return rows.groupBy("doc_id").agg(F.max("label").alias("label"))


def with_text(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(label, text) of the sampled rows. The sample is bounded by its limit, so it is broadcast and no text is shuffled."""
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id").select("label", "text")

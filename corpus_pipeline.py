"""A corpus pipeline: quality, near-duplicates, benchmark contamination, personal data, tokens.

Each stage takes all its predecessor kept and calls one operator of ``monthgrid.llm``; its result is written as Parquet to the
shared folder and read again. All stages but the last return the columns of ``documents``. A decision about an id applies to all
rows with that id; a row without an id cannot be named by a decision and stays. Stages after a decision move only the rows that
may be affected (``bits.without``), so the kept texts are not shuffled to drop the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthgrid.llm import bits, bpe, decontaminate, near_dup, pii, resample
from monthgrid.session import stage

#: Similarity from which documents count as near-duplicates, in percent.
SIMILAR = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the texts that importance resampling draws; those unlike the labelled good texts go."""
    return resample.selected(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, the smallest id, of each group of near-duplicates."""
    found = stage(near_dup.near_duplicates(docs, SIMILAR), "near-duplicates")
    kept = found.groupBy("doc_id").agg(F.max("kept").alias("kept"))
    return bits.without(docs, "doc_id", kept.filter("NOT kept"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the benchmark's passages cover by a twentieth or more."""
    found = stage(decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), "contaminated")
    return bits.without(docs, "doc_id", found.filter("contaminated").select("doc_id"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts by its kind in brackets."""
    return pii.redacted(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text, per document."""
    return bpe.digests(docs)


STAGES = [("quality classifier", quality), ("MinHash near-dedup", near_duplicates), ("benchmark decontamination", decontamination),
          ("PII", personal_data), ("byte-level BPE", tokens)]
#: The classifiers of two stages are fitted, which SQL cannot express; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

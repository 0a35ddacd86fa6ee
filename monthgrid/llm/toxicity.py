"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text's features are the hashed n-grams of 4 and 5 lower-case characters that occur in it at all. Each feature's value is its
log-count ratio between toxic and other training texts, so that logistic regression starts from what naive Bayes knows and its
penalty falls on what the counts do not support. Ratios and weights multiply into one table of ``2**BITS`` numbers, whose size no
corpus changes; it is broadcast, and documents are scored where they are read, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthgrid.llm import words as W
from monthgrid.llm.labels import labelled_sample, remainder, with_text
from monthgrid.session import stage

BITS = 18
SIZES = (4, 5)
#: Labelled rows that the model is fitted on, at most.
TRAIN_ROWS = 8000
#: Training texts that must hold a feature.
SEEN = 3
#: Standard errors that a log-count ratio must differ from 0 by.
SIGMA = 3.5
STEP = 1 << 20
_MULTIPLY = np.random.default_rng(11).integers(0, 2**32, max(SIZES), dtype=np.uint32) | np.uint32(1)


def _characters(text: str) -> np.ndarray:
    return np.frombuffer((" " + " ".join(text.lower().split()) + " ").encode("utf-32-le", "replace"), np.uint32)


def features(text: str | None, seen: np.ndarray) -> np.ndarray:
    """Sorted numbers of the features that occur in the whole text. ``seen`` is a zeroed scratch table; it is left zeroed."""
    c = _characters(text or "")
    for begin in range(0, max(1, len(c) - min(SIZES) + 1), STEP):
        part = c[begin:begin + STEP + max(SIZES) - 1]
        h = np.full(len(part), 0x9E3779B9, np.uint32)
        for k in range(max(SIZES)):
            m = len(part) - k
            if m <= 0:
                break
            h = (h[:m] ^ part[k:]) * _MULTIPLY[k]
            h ^= h >> np.uint32(15)
            if k + 1 in SIZES:
                seen[(h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS)] = True
    found = np.flatnonzero(seen)
    seen[found] = False
    return found


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = np.zeros(1 << BITS, bool)
    for b in batches:
        for i in range(0, b.num_rows, 64):
            part = b.slice(i, 64)
            found = [features(t, seen).astype(np.int32) for t in part.column("text").to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([part.column("label").cast(pa.int32()), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))],
                                             names=["label", "found"])


def fit(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS, penalty: float = 0.001) -> tuple[np.ndarray, float]:
    """(weight of each feature, intercept) from rows of ``labels`` (doc_id, label) that ``docs`` has a text for.

    Without labelled texts, or with one class only, all weights are 0 and the score is 0 or 1 as that class says (0 without any).
    """
    rows = stage(with_text(docs, labels).mapInArrow(_featurise, "label int, found array<int>"), "toxic-features")
    total = dict(map(tuple, rows.groupBy((F.col("label") > 0).alias("y")).count().collect()))
    weights = np.zeros(1 << BITS, np.float32)
    if len(total) < 2:
        return weights, 30.0 if True in total else -30.0
    counts = (rows.select((F.col("label") > 0).cast("int").alias("y"), F.explode("found").alias("f")).groupBy("f")
              .agg(F.count("*").alias("n"), F.sum("y").alias("toxic")).filter(F.col("n") >= SEEN).toArrow())  # 2**BITS rows at most
    f, n, p = (counts.column(c).to_numpy() for c in ("f", "n", "toxic"))
    order = np.argsort(f)
    f, n, p = f[order], n[order], p[order].astype(float)
    ratio = np.log((p + 1) / (total[True] + 2)) - np.log((n - p + 1) / (total[False] + 2))
    sure = np.abs(ratio) >= SIGMA * np.sqrt(1 / (p + 1) + 1 / (n - p + 1))
    f, ratio = f[sure], ratio[sure]
    if not len(f):
        return weights, float(np.log(total[True] / total[False]))
    known = docs.sparkSession.sparkContext.broadcast((f, ratio))

    def vector(found):
        f, ratio = known.value
        found = np.array(found, np.int64)
        at = np.searchsorted(f, found)
        ok = at < len(f)
        at = at[ok][f[at[ok]] == found[ok]]
        return Vectors.sparse(len(f), at, ratio[at])

    data = rows.select((F.col("label") > 0).cast("double").alias("label"), F.udf(vector, VectorUDT())("found").alias("features"))
    model = LogisticRegression(regParam=penalty, standardization=False, maxIter=60, tol=1e-5).fit(data)
    weights[f] = model.coefficients.toArray() * ratio
    return weights, float(model.intercept)


def scored(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """(doc_id, score) of every row of ``docs``. Null and empty texts have no features; repeated rows and null ids are rows like any other."""
    known = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, intercept = known.value
        seen = np.zeros(1 << BITS, bool)
        for b in W.parts(batches):
            z = [intercept + float(weights[features(t, seen)].sum(dtype=np.float64)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))))], names=["doc_id", "score"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id bigint, score double")


def op2_toxicity(spark, sf_dir) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = fit(docs, labelled_sample(labels, "toxic", TRAIN_ROWS, remainder(5) != 0))
    return scored(docs, model).select("doc_id", F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out"), "score",
                                      (F.col("score") >= 0.5).cast("int").alias("predicted"))

"""Quality by importance resampling: the ratio of two hashed n-gram models, sampled by Gumbel top-k.

Every text is a bag of words and word pairs hashed into ``BUCKETS`` slots; runs of letters and digits and runs of other symbols
are words, case is kept. One multinomial over the slots is estimated from target texts (labelled good), one from all texts, each
with ``SMOOTH`` counts per slot. A text's log importance weight is the sum of its n-grams' log ratios. Gumbel noise added to the
log weight turns the k largest sums into a sample without replacement in proportion to the weights.

k is a parameter. Left out, it is the number of texts whose log weight is at least a cut: the one that separates labelled good
and bad texts best. The cut is set on labelled texts that the target model has not seen. The noise (a standard Gumbel, mostly within 3) then only moves texts whose weight is next to the cut.

The models are two arrays of ``BUCKETS`` numbers, whatever the corpus. Counts are summed in each task before the shuffle. The
k-th largest sum is found by counting in ever finer bins; the driver sees bin counts and at most ``LAST`` sums.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthgrid.llm import words as W
from monthgrid.llm.labels import labelled_sample, with_text
from monthgrid.session import stage

BUCKETS = 1 << 14
SMOOTH = 1.0
#: Labelled rows that the target model and the cut are fitted on, at most.
TRAIN_ROWS = 20000
#: Losing a good labelled text counts as much as keeping this many bad ones.
KEEP = 5
BINS, LAST = 1024, 4096
SEED = 42

_KIND = np.full(256, 2, np.int8)
_KIND[W.ALNUM] = 1
_KIND[0x41:0x5B] = 1
_KIND[list(W.SPACES)] = 0


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(slot, text number) of every word and word pair of the texts."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    kind = _KIND[data]
    edge = np.concatenate([[0], np.flatnonzero(kind[1:] != kind[:-1]) + 1, [len(kind)]])
    start, end = edge[:-1], edge[1:]
    word = kind[start] > 0
    start, end = start[word], end[word]
    offset = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offset[1:])
    first = np.searchsorted(start, offset)
    words = W.Words(data, start, end, W.hash_spans(data, start, end), first)
    owner = words.owner()
    pairs = np.flatnonzero(W.within(words, 2))
    slots = np.concatenate([words.hash, W.ngrams(words.hash, 2)[pairs]]) >> W.U(64 - int(math.log2(BUCKETS)))
    return slots.astype(np.int64), np.concatenate([owner, owner[pairs]])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for b in W.parts(batches):
        texts = W.as_bytes(b.column(0))
        for i, j in W.batches(texts):
            total += np.bincount(tokens(texts[i:j])[0], minlength=BUCKETS)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["slot", "n"])


def slot_counts(texts: DataFrame) -> np.ndarray:
    """Counts of every slot over the first column; one row per slot and task is shuffled."""
    rows = texts.mapInArrow(_count, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS)
    out[rows.column("slot").to_numpy()] = rows.column("n").to_numpy()
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    p, q = (np.log(c + SMOOTH) - np.log((c + SMOOTH).sum()) for c in (target, raw))
    return p - q


def weight(ratio: np.ndarray, spark) -> object:
    """A function from a text column to its log importance weight; null and empty texts weigh 0."""
    known = spark.sparkContext.broadcast(ratio)

    @F.pandas_udf("double")
    def log_weight(column: pd.Series) -> pd.Series:
        texts = [(t or "").encode() for t in column]
        out = np.zeros(len(texts))
        for i, j in W.batches(texts):
            slot, owner = tokens(texts[i:j])
            out[i:j] = np.bincount(owner, known.value[slot], minlength=j - i)
        return pd.Series(out)

    return log_weight


def best_cut(good: list[float], bad: list[float]) -> float:
    """Between the weights of good and bad texts, where the weighted error rates add up to least; the lowest such place.

    Without bad texts everything passes; without good ones the cut is 0, where both models agree.
    """
    if not bad or not good:
        return -math.inf if good else 0.0
    values = np.unique(good + bad)
    cuts = np.concatenate([[values[0] - 1], (values[1:] + values[:-1]) / 2, [values[-1] + 1]])
    lost = np.searchsorted(np.sort(good), cuts) / len(good)
    kept = 1 - np.searchsorted(np.sort(bad), cuts) / len(bad)
    return float(cuts[np.argmin(KEEP * lost + kept)])


def gumbel(seed: int = SEED) -> Column:
    """Standard Gumbel noise that the id alone decides, so that a repeated task draws the same."""
    u = (F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    return -F.log(-F.log(u))


def kth_largest(df: DataFrame, column: str, k: int) -> float:
    """The k-th largest value of a column without nulls; minus infinity if there are fewer than k rows, plus infinity for k < 1."""
    if k < 1:
        return math.inf
    low, high, n = df.agg(F.min(column), F.max(column), F.count(column)).first()
    if n < k:
        return -math.inf
    x = F.col(column)
    while True:
        inside = df.filter((x >= low) & (x <= high))
        if n <= LAST or low == high:
            return low if low == high else sorted((r[0] for r in inside.select(x).collect()), reverse=True)[k - 1]
        step = (high - low) / BINS
        bins = (inside.groupBy(F.least(F.floor((x - F.lit(low)) / F.lit(step)), F.lit(BINS - 1)).alias("bin"))
                .agg(F.count("*").alias("n"), F.min(x).alias("low"), F.max(x).alias("high")).collect())
        for r in sorted(bins, key=lambda r: -r["bin"]):
            if k <= r["n"]:
                low, high, n = r["low"], r["high"], r["n"]
                break
            k -= r["n"]


def fit(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> tuple[object, float]:
    """(log weight of a text column, cut) from labels (doc_id, quality): 1 is a target text, 0 is not. All of ``docs`` is the raw side."""
    sample = stage(with_text(docs, labelled_sample(labels, "quality", limit)).withColumn("fits", F.xxhash64("text") % 2 == 0), "quality-sample")
    target = slot_counts(sample.filter("label > 0 AND fits").select("text"))
    raw = slot_counts(docs.select(F.col("text").cast("string")))
    log_weight = weight(log_ratio(target, raw) if target.sum() else np.zeros(BUCKETS), docs.sparkSession)
    weighed = sample.filter("NOT fits").select((F.col("label") > 0).alias("good"), log_weight("text").alias("w")).collect()  # ``limit`` rows at most
    return log_weight, best_cut([r.w for r in weighed if r.good], [r.w for r in weighed if not r.good])


def drawn(docs: DataFrame, labels: DataFrame, k: int | None = None, limit: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, log_weight, key, selected) of every row of ``docs`` (doc_id, text): the k rows of largest key are selected.

    Rows that tie with the k-th are selected too (equal texts under one id). Null and empty texts weigh 0. Without target texts
    all weights are 0. Null ids draw one common noise. Other columns are not read.
    """
    log_weight, cut = fit(docs, labels, limit)
    rows = stage(docs.select("doc_id", log_weight(F.col("text").cast("string")).alias("log_weight"))
                 .withColumn("key", F.col("log_weight") + gumbel()), "weights")
    k = rows.filter(F.col("log_weight") >= cut).count() if k is None else k
    return rows.withColumn("selected", F.col("key") >= F.lit(kth_largest(rows, "key", k)))


def selected(docs: DataFrame, labels: DataFrame, k: int | None = None, limit: int = TRAIN_ROWS) -> DataFrame:
    """The drawn rows of ``docs``, all columns. Each row is judged by its own text, so equal ids or null ids need no join."""
    log_weight, cut = fit(docs, labels, limit)
    key = log_weight(F.col("text").cast("string")) + gumbel()
    rows = stage(docs.select("doc_id", log_weight(F.col("text").cast("string")).alias("w")).select("w", (F.col("w") + gumbel()).alias("key")), "weights")
    k = rows.filter(F.col("w") >= cut).count() if k is None else k
    return docs.filter(key >= F.lit(kth_largest(rows, "key", k)))


def op3_importance_resampling(spark, sf_dir) -> DataFrame:
    return drawn(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels")))

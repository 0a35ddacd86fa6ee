"""Benchmark decontamination by winnowing.

Both sides keep, of every ``WINDOW`` consecutive hashes of ``GRAM`` words, the smallest (the last of equals). A shared span of
``GRAM + WINDOW - 1`` words has the same hashes on both sides, hence the same smallest one: it always shares a fingerprint.
Fingerprints are joined on equality, and each hit is extended over the words around it; only runs of a whole span count.

An item with fewer words than a span is one window of its own: documents then also hash runs of exactly that many words.

At scale: documents are scanned once. Fingerprints that no item can have are dropped in the scan by a bit table of fixed size
(``BITS``, 2 MB, whatever the inputs), so the shuffle carries candidate hits only. The bit table has no effect on the result.
Nothing is grouped by fingerprint; a passage in a third of all documents is one item row that meets many documents in a join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthgrid.llm import words as W
from monthgrid.session import stage

SPAN = 13
GRAM = 7
WINDOW = SPAN - GRAM + 1
BITS = 24
SIDE = SPAN - GRAM
AROUND = 2 * SIDE + GRAM


def winnow(words: W.Words, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the fingerprints: the last smallest of every ``window`` hashes inside one text."""
    g = W.ngrams(words.hash, gram)
    n = len(g) - window + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, W.U)
    best, at = g[:n].copy(), np.zeros(n, np.int8)
    for j in range(1, window):
        other = g[j:n + j]
        less = other <= best
        best[less] = other[less]
        at[less] = j
    keep = np.zeros(len(g), bool)
    ok = W.within(words, gram + window - 1)
    keep[(np.arange(n) + at)[ok[:n]]] = True
    pos = np.flatnonzero(keep)
    return pos, g[pos]


def _around(words: W.Words, pos: np.ndarray, outside: int) -> np.ndarray:
    """Hashes of the words around each fingerprint; ``outside`` beyond the text, which no word of the other side equals."""
    owner = words.owner()
    index = pos[:, None] + np.arange(-SIDE, GRAM + SIDE)
    safe = np.clip(index, 0, len(words.hash) - 1)
    out = words.hash[safe]
    out[(index != safe) | (owner[safe] != owner[pos][:, None])] = outside
    return out


def _marks(words: W.Words, short: list[int], outside: int, bits: np.ndarray | None, items: bool):
    """(word position, length of a short item or 0, hash, words around) of all fingerprints, text by text."""
    found = []
    for m in [0, *short]:
        if m:
            g = W.ngrams(words.hash, m)
            pos = np.flatnonzero(W.within(words, m))
            if items:  # only items of exactly m words are such a window
                size = np.diff(words.first)[words.owner()[pos]] if len(pos) else pos
                pos = pos[size == m]
            h = g[pos]
        else:
            pos, h = winnow(words)
        if bits is not None:
            slot = (h >> W.U(64 - BITS)).astype(np.int64)
            hit = (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
            pos, h = pos[hit], h[hit]
        found.append((pos, np.full(len(pos), m), h))
    pos, size, h = (np.concatenate(x) for x in zip(*found, strict=True))
    around = _around(words, pos, outside) if len(pos) else np.empty((0, AROUND), W.U)
    return pos, size, h, around


def _scan(batches: Iterator[pa.RecordBatch], schema: pa.Schema, short: list[int], bits, items: bool) -> Iterator[pa.RecordBatch]:
    for batch in W.parts(batches):
        texts = W.as_bytes(batch.column(1))
        for i, j in W.batches(texts):
            words = W.split(texts[i:j], W.ALNUM, lower=True)
            pos, size, h, around = _marks(words, short, 1 if items else 0, bits, items)
            owner = words.owner()[pos] if len(pos) else pos
            order = np.argsort(owner, kind="stable")
            ends = np.searchsorted(owner[order], np.arange(j - i + 1))
            marks = pa.StructArray.from_arrays(
                [pa.array((pos - words.first[owner])[order].astype(np.int32)), pa.array(size[order].astype(np.int32)),
                 pa.array(h[order].view(np.int64)),
                 pa.array([x.tobytes() for x in around[order]], pa.binary())],
                names=["pos", "size", "mark", "around"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), pa.array(np.diff(words.first).astype(np.int64)),
                 pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), marks)], schema=schema)


def _marked(df: DataFrame, short: list[int], bits, items: bool, parts: int | None = None) -> DataFrame:
    kind = df.schema[0].dataType.simpleString()
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    mark = pa.struct([("pos", pa.int32()), ("size", pa.int32()), ("mark", pa.int64()), ("around", pa.binary())])
    schema = pa.schema([("id", arrow), ("n_words", pa.int64()), ("marks", pa.list_(mark))])
    ddl = f"id {kind}, n_words bigint, marks array<struct<pos:int,size:int,mark:bigint,around:binary>>"

    def run(it):
        return _scan(it, schema, short, bits if bits is None else np.frombuffer(bits.value, np.uint8), items)

    return df.mapInArrow(run, ddl)


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The run of equal words through each joined fingerprint, where it is a whole span."""
    for b in batches:
        pos, size = b.column("pos").to_numpy(), b.column("size").to_numpy()
        if not len(pos):
            continue
        a, c = (np.frombuffer(b"".join(b.column(x).to_pylist()), W.U).reshape(-1, AROUND) for x in ("around", "item_around"))
        same = a == c
        left = np.cumprod(same[:, SIDE - 1::-1], axis=1).sum(axis=1)
        right = np.cumprod(same[:, SIDE + GRAM:], axis=1).sum(axis=1)
        whole = same[:, SIDE:SIDE + GRAM].all(axis=1) & (left + right + GRAM >= SPAN)
        short = size > 0
        ok = pa.array(whole | short)
        begin = np.where(short, pos, pos - left)
        end = np.where(short, pos + size, pos + GRAM + right)
        out = pa.RecordBatch.from_arrays([b.column("row"), b.column("item_id"), pa.array(begin.astype(np.int64)), pa.array(end.astype(np.int64))],
                                         names=["row", "item_id", "begin", "end"])
        yield out.filter(ok)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Null and empty texts have no words and are clean; items without words match nothing. Repeated rows are judged one by one;
    rows with a null id too. Repeated item ids count once. Other columns are not read.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("id"), F.col("text").cast("string").alias("text"))
    counted = stage(_marked(items, [], None, True).select("n_words").groupBy("n_words").count(), "item-lengths")
    short = [r.n_words for r in counted.filter(F.col("n_words").between(1, SPAN - 1)).orderBy("n_words").collect()]  # 12 at most
    marks = stage(_marked(items, short, None, True).select("id", F.explode("marks").alias("m"))
                  .select(F.col("id").alias("item_id"), "m.size", "m.mark", F.col("m.around").alias("item_around")).distinct(), "item-marks")
    slots = marks.select(F.shiftrightunsigned("mark", 64 - BITS).alias("slot")).distinct()
    table = np.zeros(1 << (BITS - 3), np.uint8)
    # a row for each byte of the table that is not 0: 2 MB whatever the benchmark's size
    for r in slots.groupBy(F.expr("slot div 8").alias("at")).agg(
            F.expr("bit_or(shiftleft(1, cast(slot % 8 AS int)))").alias("v")).toLocalIterator():
        table[r["at"]] = r["v"]
    bits = spark.sparkContext.broadcast(table.tobytes())
    scanned = stage(_marked(docs.select("doc_id", F.col("text").cast("string").alias("text")), short, bits, False)
                    .withColumn("row", F.monotonically_increasing_id()), "document-marks")
    hits = stage(scanned.select("row", F.explode("marks").alias("m")).select("row", "m.*")
                 .join(marks, ["size", "mark"])
                 .mapInArrow(_extend, "row bigint, item_id string, begin bigint, end bigint").distinct(), "hits")
    before = F.max("end").over(Window.partitionBy("row").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, -1))
    covered = (hits.groupBy("row", "begin").agg(F.max("end").alias("end"))
               .withColumn("fresh", F.greatest(F.lit(0), F.col("end") - F.greatest("begin", F.coalesce(before, F.lit(0)))))
               .groupBy("row").agg(F.sum("fresh").alias("n_hit")))
    named = (hits.select("row", "item_id").distinct().groupBy("row")
             .agg(F.count("*").alias("n_items"), F.array_sort(F.collect_set("item_id")).alias("items")))
    n_hit = F.coalesce("n_hit", F.lit(0))
    return (scanned.select("row", F.col("id").alias("doc_id"), "n_words")
            .join(covered.join(named, "row"), "row", "left")
            .select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
                    F.sha2(F.coalesce(F.concat_ws(",", "items"), F.lit("")), 256).alias("items_sha256"),
                    ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated")))


def op6_decontaminate(spark, sf_dir) -> DataFrame:
    return contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_SMALL}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), {SPAN}) AS m, array_to_string(w[i:i + least(len(w), {SPAN}) - 1], ' ') AS g
       FROM (SELECT *, unnest(range(1, greatest(len(w) - {SPAN} + 1, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT m FROM bw),
dw AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS g
       FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, sizes WHERE len(w) >= m)),
hit AS (SELECT doc_id, item_id, i, m FROM dw JOIN bw USING (m, g)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS s
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(named.n, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(covered.n, 0) > 0 AND 20 * coalesce(covered.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

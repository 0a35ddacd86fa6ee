"""Near-duplicates by a multi-index Hamming join on b-bit MinHash signatures, every link confirmed on the full sets.

A document's set is its distinct 5-word shingles. Equal sets form one class, found by a 128-bit digest, so copies never meet
in pairs. Each class has a signature of ``CHUNKS * WIDTH`` MinHash values cut to 16 bits. The signature is split into CHUNKS
chunks; a chunk may hold one error, so each of its WIDTH values is left out in turn and the rest is a key. By pigeonhole two
signatures that differ in at most ``2 * CHUNKS - 1`` of their values share a key: with 10 chunks of 5, up to 19 of 50. Sets
with a similarity of 0.85 differ in 7.5 on average (more than 19: under 1 pair in 100,000), and pairs beyond 19 usually
share a key too: all ten chunks must hold two errors or more to miss it (under 1e-7; at 0.8, 2e-6).

Buckets are never expanded into pairs. Each bucket elects a hub, the member that shares most buckets with others, and every
member is compared with its hubs: a star. What is left are pairs of one star of which one at least is not linked to the hub. Two
such sets are as far apart as their differences from the hub: ``|x ^ y| = |(x ^ hub) ^ (y ^ hub)|``. If the sets are linked, those
differences must overlap in a number of shingles that follows from the sizes (``_least_overlap``), so with a common order, rarest
first, the first few of each must meet. Those are joined, and the pairs they give, hardly more than the linked ones, are
confirmed. Where many meet, a member is first elected that all others there are compared with: a family of near copies that is not
linked to its hub then costs one comparison per member and not one per pair, as two that are linked to the same need no
comparison. All members of a star may differ by their own edits: they then share no rare difference and meet nowhere.

Texts move only if they are compared: documents are thinned by a bit table of fixed size before the exact join. The members of a
hot hub are split over tasks by Spark's skew join. Components come from large-star/small-star rounds over the confirmed links, each
round written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthgrid.llm import words as W
from monthgrid.llm.bits import maybe_in
from monthgrid.session import stage

SHINGLE = 5
CHUNKS, WIDTH = 10, 5
VALUES = CHUNKS * WIDTH
#: Where more than SMALL members of a star share a rare difference, members are elected that all others there are compared with,
#: one per star and round, ROUNDS times at most.
SMALL, ROUNDS = 32, 3
_rng = np.random.default_rng(7)
_FLIP = _rng.integers(0, 2**64, VALUES, dtype=W.U)
_TIMES = _rng.integers(0, 2**64, VALUES, dtype=W.U) | W.U(1)
_KEY = _rng.integers(0, 2**64, (CHUNKS, WIDTH), dtype=W.U)


def _few(df: DataFrame, label: str) -> DataFrame:
    """Stages rows of a few numbers each in as many files as the cluster has cores, not one per shuffle partition."""
    return stage(df.coalesce(max(1, df.sparkSession.sparkContext.defaultParallelism)), label)


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words has its whole sequence as the only one."""
    words = W.split(texts, lower=True)
    grams = [W.ngrams(words.hash, n) for n in range(1, size + 1)]
    out = []
    for a, b in zip(words.first[:-1], words.first[1:]):
        n = min(size, b - a)
        out.append(np.unique(grams[n - 1][a:b - n + 1]) if n else np.empty(0, W.U))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """16-bit MinHash values, a row per set; sets must not be empty."""
    at = np.zeros(len(sets), np.int64)
    np.cumsum([len(s) for s in sets[:-1]], out=at[1:])
    flat = np.concatenate(sets)
    low = np.empty((len(sets), VALUES), W.U)
    for k in range(VALUES):
        low[:, k] = np.minimum.reduceat((flat ^ _FLIP[k]) * _TIMES[k], at)
    return W.mix(low).astype(np.uint16)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.parts(batches):
        texts = W.as_bytes(batch.column(1))
        for i, j in W.batches(texts):
            sets = shingle_sets(texts[i:j])
            n = np.array([len(s) for s in sets])
            full = np.flatnonzero(n)
            a, b, sig = np.zeros(j - i, W.U), np.zeros(j - i, W.U), [b""] * (j - i)
            if len(full):
                some = [sets[k] for k in full]
                at = np.concatenate([[0], np.cumsum(n[full])[:-1]])
                flat = np.concatenate(some)
                a[full] = np.add.reduceat(W.mix(flat), at)
                b[full] = np.bitwise_xor.reduceat(W.mix(flat + _FLIP[0]), at)
                for k, s in zip(full, signatures(some)):
                    sig[k] = s.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(n.astype(np.int64)), pa.array(a.view(np.int64)),
                                              pa.array(b.view(np.int64)), pa.array(sig, pa.binary())], names=["doc_id", "n", "a", "b", "sig"])
    W.give_back()


def chunk_keys(sig: np.ndarray) -> np.ndarray:
    """All keys of each signature: every chunk with each of its values left out."""
    parts = sig.reshape(-1, CHUNKS, WIDTH).astype(W.U)
    out = np.empty(parts.shape, W.U)
    for skip in range(WIDTH):
        total = np.broadcast_to(_KEY[:, skip], parts.shape[:2]).copy()
        for p in range(WIDTH):
            if p != skip:
                total += (parts[:, :, p] + W.U(1)) * _TIMES[p]
        out[:, :, skip] = W.mix(total + _KEY[:, skip])
    return out.reshape(len(sig), -1)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, 4096):
            part = b.slice(i, 4096)
            sig = np.frombuffer(b"".join(part.column("sig").to_pylist()), np.uint16).reshape(-1, VALUES)
            keys = chunk_keys(sig)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)),
                                              pa.array(np.repeat(part.column("rep").to_numpy(), VALUES))], names=["key", "rep"])


def _compare(percent: int):
    """Exact comparison of the two texts of each pair: sizes, whether they are linked, and the shingles in one of them only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, hub = None, None
        for b in W.parts(batches):
            ids, hubs = b.column("a").to_pylist(), b.column("b").to_pylist()
            left, right = W.as_bytes(b.column("a_text")), W.as_bytes(b.column("b_text"))
            for i, j in W.batches(left):
                out = []
                for k, own in zip(range(i, j), shingle_sets(left[i:j])):
                    if right[k] != last:
                        last, hub = right[k], shingle_sets([right[k]])[0]
                    apart = np.setxor1d(own, hub, assume_unique=True)
                    both = (len(own) + len(hub) - len(apart)) // 2
                    linked = both > 0 and 100 * both >= percent * (both + len(apart))
                    out.append((ids[k], hubs[k], linked, len(own), len(hub), apart.view(np.int64)))
                a, h, linked, m, n, apart = zip(*out)
                ends = np.concatenate([[0], np.cumsum([len(x) for x in apart])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(h, pa.int64()), pa.array(linked), pa.array(m, pa.int64()), pa.array(n, pa.int64()),
                                                  pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(apart)))],
                                                 names=["a", "b", "linked", "n_a", "n_b", "apart"])
        W.give_back()
    return run


def _compared(pairs: DataFrame, docs: DataFrame, percent: int, label: str) -> DataFrame:
    """(a, b, linked, n_a, n_b, apart) of ``pairs`` (a, b), judged on the full sets, written to the shared folder."""
    pairs = _few(pairs, f"{label}-pairs")
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    texts = docs.filter(maybe_in(wanted, "doc_id")(F.col("doc_id"))).join(wanted, "doc_id", "left_semi")
    # the last join is by hub: where a hub is hot, Spark splits its members' side of the join, which holds the texts
    full = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("a_text")), "a").join(
        texts.select(F.col("doc_id").alias("b"), F.col("text").alias("b_text")), "b")
    return stage(full.select("a", "b", "a_text", "b_text").mapInArrow(
        _compare(percent), "a bigint, b bigint, linked boolean, n_a bigint, n_b bigint, apart array<bigint>"), label)


def _least_overlap(percent: int) -> dict:
    """Least overlap of a member's difference from the hub (``size`` shingles) with that of a member it is linked to.

    Linked means ``|x ^ y| <= c * (|x| + |y|)`` with ``c = (100 - percent) / (100 + percent)``; as ``|y| <= |hub| + |y ^ hub|``, a
    member not linked to the hub needs ``(size - c * (n_a + n_b)) / (1 + c)`` whatever its partner (``any``), and every member needs
    ``size * (1 - c) / 2`` if its partner is not linked to the hub (``open``). Rounded down by a hair, so never too many.
    """
    c = (100 - percent) / (100 + percent)
    at_least = lambda x: F.greatest(F.lit(1), F.ceil(x - 1e-6)).cast("int")
    size = F.col("size")
    return {"any": at_least((size - c * (F.col("n_a") + F.col("n_b"))) / (1 + c)), "open": at_least(size * (1 - c) / 2)}


def _ahead(stars: DataFrame, percent: int) -> DataFrame:
    """(b, a, linked, size, n, e, i, to_open, to_linked): the rare differences from its hub at which a member must meet what it is linked to."""
    rich = stars.groupBy("b").agg(F.count("*").alias("n"), F.min("linked").alias("all")).filter("n > 1 AND NOT all").select("b")
    members = stars.join(rich, "b").withColumn("size", F.size("apart"))
    shingles = stage(members.select("b", "a", "linked", "size", "n_a", "n_b", F.explode("apart").alias("e")), "differences")
    often = shingles.groupBy("b", "e").count().filter("count > 1")  # one that no other member has joins nothing, but keeps its place in the order
    by_rarity = Window.partitionBy("b", "a").orderBy(F.coalesce("count", F.lit(1)), "e")
    need = _least_overlap(percent)
    placed = (shingles.join(often, ["b", "e"], "left").withColumn("i", F.row_number().over(by_rarity)).filter("count > 1")
              .withColumn("any", need["any"]).withColumn("open", need["open"]))
    return stage(placed.select("b", "a", "linked", "size", F.col("n_a").alias("n"), "e", "i",
                               (F.col("i") <= F.col("size") - F.when(F.col("linked"), F.col("open")).otherwise(F.greatest("any", "open")) + 1).alias("to_open"),
                               (~F.col("linked") & (F.col("i") <= F.col("size") - F.col("any") + 1)).alias("to_linked"))
                 .filter("to_open OR to_linked"), "rare-differences")


def _families(ahead: DataFrame, docs: DataFrame, percent: int, small: int, rounds: int) -> tuple[DataFrame, DataFrame]:
    """(links, names): members of a star that are linked to one elected member share its id as ``name`` (b, a, name); others are not named.

    A round elects one member per star, among those not named yet: the one in most groups of more than ``small`` members that are not of
    one name. It is compared with all that share such a group with it.
    """
    spark = ahead.sparkSession
    links, names = (spark.createDataFrame([], t) for t in ("a bigint, b bigint", "b bigint, a bigint, name bigint"))
    tried = spark.createDataFrame([], "b bigint, a bigint")
    large = ahead.groupBy("b", "e").count().filter(F.col("count") > small).select("b", "e")
    crowd = stage(ahead.join(large, ["b", "e"]).select("b", "e", "a", "linked"), "crowds")
    for _ in range(rounds):
        named = crowd.join(names, ["b", "a"], "left").withColumn("free", ~F.col("linked") & F.col("name").isNull())
        name = F.when(F.col("linked"), F.col("b")).otherwise(F.coalesce("name", "a"))
        mixed = named.groupBy("b", "e").agg(F.min(name).alias("low"), F.max(name).alias("high")).filter("low <> high").select("b", "e")
        open_groups = stage(named.join(mixed, ["b", "e"]), "mixed")
        votes = open_groups.filter("free").groupBy("b", "a").count().join(tried, ["b", "a"], "left_anti")
        elected = votes.groupBy("b").agg(F.max(F.struct("count", (-F.col("a")).alias("minus"))).alias("top")).select("b", (-F.col("top.minus")).alias("leader"))
        his = open_groups.join(elected, "b").filter("a = leader").select("b", "e", "leader")
        meet = _few(open_groups.join(his, ["b", "e"]).filter("a <> leader").select("b", "a", "leader").distinct(), "electorate")
        if meet.isEmpty():
            break
        found = _compared(meet.select("a", F.col("leader").alias("b")).distinct(), docs, percent, "families").filter("linked").select("a", F.col("b").alias("leader"))
        new = meet.join(found, ["a", "leader"])
        links = links.union(found)
        fresh = new.select("b", "a", F.col("leader").alias("name")).union(meet.select("b", F.col("leader").alias("a"), F.col("leader").alias("name")).distinct())
        names = _few(names.union(fresh.join(names, ["b", "a"], "left_anti")), "names")
        tried = _few(tried.union(meet.select("b", F.col("leader").alias("a")).distinct()), "tried")
    return links, names


def _left_over(ahead: DataFrame, names: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of star members that may be linked though neither their hub nor an elected member connects them."""
    c = (100 - percent) / (100 + percent)
    named = ahead.join(names, ["b", "a"], "left").withColumn("name", F.when(F.col("linked"), F.col("b")).otherwise(F.coalesce("name", "a")))
    mixed = named.groupBy("b", "e").agg(F.min("name").alias("low"), F.max("name").alias("high")).filter("low <> high").select("b", "e")
    named = named.join(mixed, ["b", "e"], "left_semi")
    x, y = (named.select("b", "e", *[F.col(k).alias(f"{k}_{s}") for k in ("a", "name", "linked", "size", "n", "i", "to_open", "to_linked")]) for s in "xy")
    # x is not linked to the hub. Its partner is not either (each pair once), or is.
    pair = (~F.col("linked_x") & ((~F.col("linked_y") & F.col("to_open_x") & F.col("to_open_y") & (F.col("a_x") < F.col("a_y")))
                                  | (F.col("linked_y") & F.col("to_linked_x") & F.col("to_open_y"))))
    enough = 1 + F.least(F.col("size_x") - F.col("i_x"), F.col("size_y") - F.col("i_y")) >= (
        F.col("size_x") + F.col("size_y") - c * (F.col("n_x") + F.col("n_y"))) / 2 - 1e-6
    return x.join(y, ["b", "e"]).filter(pair & enough & (F.col("name_x") != F.col("name_y"))).select(F.least("a_x", "a_y").alias("a"), F.greatest("a_x", "a_y").alias("b")).distinct()


def linked_stars(star: DataFrame, docs: DataFrame, percent: int, small: int = SMALL, rounds: int = ROUNDS) -> DataFrame:
    """Confirmed links (a, b) that connect all that is linked among the members of each star (a, b: hub); doc ids of ``docs``."""
    found = _compared(star, docs, percent, "stars")
    ahead = _ahead(found, percent)
    links, names = _families(ahead, docs, percent, small, rounds)
    more = _compared(_left_over(ahead, names, percent), docs, percent, "left-over")
    return found.filter("linked").select("a", "b").union(links).union(more.filter("linked").select("a", "b"))


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b) but the smallest of each component, which is the component's name.

    Large-star and small-star rounds until nothing changes; their number grows with the logarithm of the links. Null ends are
    dropped, repeated links and loops do not matter, no links give no rows.
    """
    e = (links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
         .filter("a IS NOT NULL AND b IS NOT NULL AND u > v").distinct())
    e, seen = _few(e, "links"), None
    while True:
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen:
            return e.select(F.col("u").alias("id"), F.col("v").alias("component"))
        seen = now
        both = e.union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        e = _few(small.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                  .union(least.select("u", F.col("m").alias("v"))).distinct(), "links")


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Links are pairs with ``100 * intersection >= percent * union``; component_id is the smallest id reachable. Null and empty
    texts have the empty set and link with nothing, not even each other. Rows with one id count as one document; rows without an
    id take the smallest id of their equals, or stay null and kept. Other columns are not read.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    signed = stage(docs.mapInArrow(_sign, "doc_id bigint, n bigint, a bigint, b bigint, sig binary"), "signatures")
    classes = stage(signed.filter("n > 0").groupBy("a", "b").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"),
                                                                  F.first("n").alias("n")), "classes")
    named = classes.filter("rep IS NOT NULL")
    keys = named.select("rep", "sig").mapInArrow(_keys, "key bigint, rep bigint")
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    buckets = stage(keys.join(shared, "key"), "buckets")
    degree = buckets.groupBy("rep").agg(F.sum("n").alias("degree"))
    hubs = buckets.join(degree, "rep").groupBy("key").agg(F.max(F.struct("degree", (-F.col("rep")).alias("minus"))).alias("top")).select("key", (-F.col("top.minus")).alias("b"))
    star = buckets.join(hubs, "key").filter("rep <> b").select(F.col("rep").alias("a"), "b").distinct()
    final = components(linked_stars(star, docs, percent))
    label = classes.select("a", "b", "rep").join(final.withColumnRenamed("id", "rep"), "rep", "left")
    found = (signed.select("doc_id", "n", "a", "b")
             .join(label.select("a", "b", F.coalesce("component", "rep").alias("component_id")), ["a", "b"], "left"))
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"))


def op9_minhash_near_dup(spark, sf_dir) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
both_in AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM both_in JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach AS (SELECT doc_id, doc_id AS c FROM d UNION SELECT link.b, reach.c FROM reach JOIN link ON link.a = reach.doc_id),
top AS (SELECT doc_id, min(c) AS c FROM reach GROUP BY 1)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c AS component_id, doc_id = c AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN top USING (doc_id)
"""

"""Texts as blocks: positions into a list of distinct pieces, and the pieces dealt out by bucket.

A block holds about ``size`` characters of whole texts. Its texts become positions into the block's own list of distinct pieces
(tokens, words), and the list is dealt into buckets by a hash of the piece. What is shuffled by bucket is then one compressed row
per block and bucket, not a row per token: a piece that makes up a third of the corpus still occurs once per block. Everything
about a piece happens in its bucket, once for the whole corpus, and goes back to the blocks by position.

A task holds one block, or the distinct pieces of one bucket. Both are set by parameters, not by the size of the corpus.
"""

from __future__ import annotations

import uuid
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthgrid.llm.words import give_back, parts
from monthgrid.session import freed_shuffles, new_path

#: Characters of text that share one list of distinct pieces.
SIZE = 16 << 20
_LEVEL = 3
_CHUNK = 1 << 18


def zip_ints(x: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(x, np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(x).to_bytes(8, "little") + pa.Codec("zstd", _LEVEL).compress(planes, asbytes=True)


def unzip_ints(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = pa.Codec("zstd").decompress(data[8:], 4 * n, asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(4, n).T.copy().view(np.uint32).ravel()


def zip_longs(x: np.ndarray) -> bytes:
    """Unsigned 64-bit numbers, byte plane by byte plane, compressed; sorted hashes and small numbers shrink most."""
    planes = np.ascontiguousarray(x, np.uint64).view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(x).to_bytes(8, "little") + pa.Codec("zstd", _LEVEL).compress(planes, asbytes=True)


def unzip_longs(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = pa.Codec("zstd").decompress(data[8:], 8 * n, asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(8, n).T.copy().view(np.uint64).ravel()


def zip_counts(x: np.ndarray) -> bytes:
    """Unsigned numbers, in only as many byte planes as the largest needs."""
    planes = (int(x.max()).bit_length() + 7) // 8 if len(x) else 0
    head = len(x).to_bytes(8, "little") + bytes([planes])
    if not planes:
        return head
    return head + pa.Codec("zstd", _LEVEL).compress(np.ascontiguousarray(x, np.uint64).view(np.uint8).reshape(-1, 8)[:, :planes].T.tobytes(), asbytes=True)


def unzip_counts(data: bytes) -> np.ndarray:
    n, planes = int.from_bytes(data[:8], "little"), data[8]
    out = np.zeros((n, 8), np.uint8)
    if planes:
        out[:, :planes] = np.frombuffer(pa.Codec("zstd").decompress(data[9:], planes * n, asbytes=True), np.uint8).reshape(planes, n).T
    return out.view(np.uint64).ravel()


def zip_steps(x: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers by their steps, for such as mostly ascend."""
    return zip_ints(np.diff(np.ascontiguousarray(x, np.uint32), prepend=np.uint32(0)))


def unzip_steps(data: bytes) -> np.ndarray:
    return np.cumsum(unzip_ints(data), dtype=np.uint32)


def zip_pieces(pieces: list[bytes]) -> bytes:
    sizes, text = zip_ints(np.fromiter(map(len, pieces), np.uint32, len(pieces))), b"".join(pieces)
    return len(sizes).to_bytes(8, "little") + len(text).to_bytes(8, "little") + sizes + pa.Codec("zstd", _LEVEL).compress(text, asbytes=True)


def unzip_pieces(data: bytes) -> list[bytes]:
    a, n = int.from_bytes(data[:8], "little"), int.from_bytes(data[8:16], "little")
    sizes = unzip_ints(data[16:16 + a])
    text = pa.Codec("zstd").decompress(data[16 + a:], n, asbytes=True)
    ends = np.cumsum(sizes, dtype=np.int64)
    return [text[i:j] for i, j in zip((ends - sizes).tolist(), ends.tolist())]


def arrow_type(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "string": pa.string()}[kind]


def pairs_of(seq: np.ndarray, kinds: int) -> np.ndarray:
    """Code of each piece of a block with the piece before it: ``piece * kinds + before``.

    The texts must end with one piece of their own kind, so that what is before a text's first piece is the end of another text.
    """
    return seq.astype(np.int64) * kinds + np.roll(seq, 1)


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct numbers of ``x``, none below 0, and the place of each number among them."""
    bits = len(x).bit_length()
    if not len(x) or int(x.max()).bit_length() + bits > 63:
        return np.unique(x, return_inverse=True)
    s = np.sort(x.astype(np.int64) << bits | np.arange(len(x)))  # numbers sort several times faster than an order of them is found
    value = s >> bits
    first = np.concatenate([[True], value[1:] != value[:-1]])
    place = np.empty(len(x), np.int64)
    place[s & ((1 << bits) - 1)] = np.cumsum(first) - 1
    return value[first], place


def _pairs(seq, learning, kinds):
    """Distinct pairs sorted by piece and the one before, how often each is learnt, and where each piece's pairs begin and how many."""
    s = np.sort(pairs_of(seq, kinds) << 1 | learning)
    first = np.flatnonzero(np.concatenate([[True], s[1:] >> 1 != s[:-1] >> 1])) if len(s) else np.zeros(0, np.int64)
    code = s[first] >> 1
    n = np.bincount(code // kinds, minlength=kinds)
    return code % kinds, np.add.reduceat(s & 1, first) if len(s) else s, np.cumsum(n) - n, n


def _dealt(pieces: list[bytes], buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket that has some of the pieces, with the numbers of these, the pieces in order."""
    bucket = np.fromiter(map(zlib.crc32, pieces), np.int64, len(pieces)) % buckets
    order = np.fromiter(sorted(range(len(pieces)), key=pieces.__getitem__), np.int64, len(pieces))
    order = order[np.argsort(bucket[order], kind="stable")]
    for some in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        if len(some):
            yield int(bucket[some[0]]), some


def _learning(docs: list[dict]) -> np.ndarray:
    """Whether each piece of a block is learnt from."""
    return np.repeat([d["learns"] for d in docs], [d["n"] for d in docs]).astype(bool)


def _pack(find: Callable, buckets: int | None, size: int, ids: pa.DataType):
    doc = pa.struct([("doc_id", ids), ("n", pa.int64()), ("learns", pa.bool_())])
    part = pa.struct([("bucket", pa.int32()), ("pieces", pa.binary()), ("at", pa.binary()), ("learnt", pa.binary())])
    schema = pa.schema([("block", pa.int64()), ("docs", pa.list_(doc)), ("places", pa.binary()), ("parts", pa.list_(part)) if buckets else ("pieces", pa.binary())])

    def close(number, docs, seen, places):
        seen.default_factory = None  # it refers to its dictionary: the cycle would keep all pieces until Python next looks for cycles
        seq = np.concatenate(places)
        places.clear()
        chunks = [seq[i:i + _CHUNK] for i in range(0, len(seq), _CHUNK)]  # of which alone there are copies
        order = np.argsort(-sum((np.bincount(x, minlength=len(seen)) for x in chunks), np.zeros(len(seen), np.int64)), kind="stable")  # frequent pieces get small numbers
        rank = np.empty(len(seen), np.uint32)
        rank[order] = np.arange(len(seen), dtype=np.uint32)
        for x in chunks:
            x[:] = rank[x]
        pieces = [p if isinstance(p, bytes) else p.encode() for p in seen]
        if not buckets:
            return pa.RecordBatch.from_pylist([{"block": number, "docs": docs, "places": zip_ints(seq), "pieces": zip_pieces([pieces[i] for i in order.tolist()])}], schema)
        learnt = np.bincount(seq[_learning(docs)], minlength=len(seen))
        bucket = np.fromiter((zlib.crc32(p) % buckets for p in pieces), np.int32, len(pieces))
        dealt = []
        for k in np.unique(bucket).tolist():
            some = sorted(((pieces[i], rank[i]) for i in np.flatnonzero(bucket == k).tolist()))
            at = np.array([r for _, r in some], np.uint32)
            dealt.append({"bucket": k, "pieces": zip_pieces([p for p, _ in some]), "at": zip_ints(at), "learnt": zip_ints(learnt[at])})
        return pa.RecordBatch.from_pylist([{"block": number, "docs": docs, "places": zip_ints(seq), "parts": dealt}], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32

        def fresh():
            seen = defaultdict()
            seen.default_factory = seen.__len__
            return [], seen, []

        (docs, seen, places), filled = fresh(), 0
        for b in parts(batches):
            for key, text, learns in zip(*(c.to_pylist() for c in b.columns)):
                text = text or ""
                if docs and filled + len(text) > size:
                    yield close(number, docs, seen, places)
                    (docs, seen, places), filled, number = fresh(), 0, number + 1
                    give_back()
                row = np.fromiter(map(seen.__getitem__, find(text)), np.uint32)
                docs.append({"doc_id": key, "n": len(row), "learns": learns})
                places.append(row)
                filled += len(text)
        if docs:
            yield close(number, docs, seen, places)
        del docs, seen, places
        give_back()
    return run


def kept_by(rows: DataFrame, key: str, label: str) -> DataFrame:
    """Written to the shared folder, bucketed and sorted by ``key``, so that grouping or joining by it does not move the rows.

    Spark writes buckets only through its catalog. The name is dropped at once; the files stay, and the frame goes on reading them.
    """
    spark, name = rows.sparkSession, f"{label}_{uuid.uuid4().hex}"
    with freed_shuffles(spark):
        (rows.write.format("parquet").option("compression", "zstd").option("path", new_path(spark, label))
         .bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).sortBy(key).saveAsTable(name))
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def packed(docs: DataFrame, find: Callable, learns=None, size: int = SIZE, buckets: int | None = None, dealt: bool = True) -> DataFrame:
    """(block, docs, places, parts) of ``docs`` (doc_id, text), written to the shared folder.

    The table is bucketed by block, so grouping what comes back by block moves that alone, not the blocks.

    ``find`` gives a text's pieces (str or bytes) in order; null counts as the empty text. ``learns`` marks texts whose pieces are
    counted in ``learnt``. Unless ``dealt``, a block has its ``pieces`` in the order of their numbers in place of the parts, for
    ``with_pairs``. The rows of a block stay together; repeated rows and null ids are rows like any other.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    buckets = (buckets or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))) if dealt else None
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), (F.lit(True) if learns is None else learns).alias("learns"))
    more = "parts array<struct<bucket:int,pieces:binary,at:binary,learnt:binary>>" if dealt else "pieces binary"
    return kept_by(rows.mapInArrow(_pack(find, buckets, size, arrow_type(kind)),
                                   f"block bigint, docs array<struct<doc_id:{kind},n:bigint,learns:boolean>>, places binary, {more}"), "block", "blocks")


_PAIRS = ("pieces", "at", "learnt", "sizes", "contexts", "context_at", "times")


def with_pairs(blocks: DataFrame, buckets: int, hashes: Callable) -> DataFrame:
    """(block, bucket, pieces, at, learnt, sizes, contexts, context_at, times) of blocks that are not dealt, a row per block and bucket.

    Besides the bucket's pieces a row holds their distinct pairs with the piece before (``pairs_of``): by piece in the order of ``at`` how
    many (``sizes``), by number of the piece before its place (``context_at``) in the ``hashes`` of such pieces (``contexts``), and how
    often each pair is learnt (``times``).
    """
    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), *((c, pa.binary()) for c in _PAIRS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches, 1):  # a block at a time
            for row in b.to_pylist():
                seq, pieces, learning = unzip_ints(row["places"]), unzip_pieces(row["pieces"]), _learning(row["docs"])
                learnt = np.bincount(seq[learning], minlength=len(pieces))
                before, times, start, n_before = _pairs(seq, learning, len(pieces))
                known, every = hashes(pieces), np.arange(len(before))
                del seq, learning
                for k, at in _dealt(pieces, buckets):
                    take, sizes = ragged(every, start, n_before, at)
                    some, place = distinct(before[take])
                    values = (zip_pieces([pieces[i] for i in at.tolist()]), zip_ints(at), zip_ints(learnt[at]), zip_ints(sizes), zip_longs(known[some]),
                              zip_steps(place), zip_ints(times[take]))
                    yield pa.RecordBatch.from_arrays([pa.array([row["block"]]), pa.array([k], pa.int32()), *(pa.array([v], pa.binary()) for v in values)], schema=schema)
        give_back()
    return blocks.select("block", "docs", "places", "pieces").mapInArrow(run, "block bigint, bucket int, " + ", ".join(f"{c} binary" for c in _PAIRS))


def by_bucket(blocks: DataFrame) -> DataFrame:
    """(block, bucket, pieces, at, learnt), a row per block and bucket."""
    return blocks.select("block", F.inline("parts"))


def ragged(flat: np.ndarray, start: np.ndarray, size: np.ndarray, take: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``flat[start[k]:start[k] + size[k]]`` for every k in ``take``, one after the other; and the sizes."""
    n = size[take]
    shift = np.repeat(start[take] - (np.cumsum(n) - n), n)
    return flat[shift + np.arange(len(shift))], n

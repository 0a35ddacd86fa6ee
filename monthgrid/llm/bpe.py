"""Byte-level BPE encoding and decoding with a given rank file.

Encoding cuts texts into pre-tokens, a block of texts at a time (``blocks``): a block keeps its pre-tokens' positions as numbers
into its own list of distinct pieces, and what is shuffled is each block's distinct pieces by bucket, not every pre-token. The
bucket merges each piece once for the whole corpus; the ids return to their blocks and are laid out by position there.

Decoding looks ids up in the token-byte table. The table has one row per id of the vocabulary, whose size the rank file fixes
whatever the corpus, so it is broadcast.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthgrid.llm.blocks import SIZE, arrow_type, by_bucket, packed, ragged, unzip_ints, unzip_pieces, zip_ints
from monthgrid.llm.words import give_back

#: Longer pieces are merged with a heap, so that a run of a million letters stays near-linear.
HEAP_FROM = 64
#: White space as the rank files' own library understands it, which leaves out the separators U+001C to U+001F.
WHITE = r"\p{White_Space}"


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank; a line of the file is the base64 of a token, and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


@lru_cache(maxsize=4)
def splitter(pattern: str) -> regex.Pattern:
    return regex.compile(pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\S", f"[^{WHITE}]").replace(r"\s", f"[{WHITE}]"))


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: again and again the adjacent pair of lowest rank, the first of equals, becomes one token."""
    get = ranks.get
    if (whole := get(piece)) is not None:
        return [whole]
    if len(piece) >= HEAP_FROM:
        return _merge_long(piece, ranks)
    cut = list(range(len(piece) + 1))
    costs = [get(piece[i:i + 2], _NONE) for i in range(len(piece) - 1)]
    while costs:
        best = min(costs)
        if best == _NONE:
            break
        i = costs.index(best)
        del cut[i + 1], costs[i]
        if i < len(costs):
            costs[i] = get(piece[cut[i]:cut[i + 2]], _NONE)
        if i:
            costs[i - 1] = get(piece[cut[i - 1]:cut[i + 1]], _NONE)
    return [ranks[piece[i:j]] for i, j in zip(cut, cut[1:])]


_NONE = 1 << 60


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    n = len(piece)
    end = list(range(1, n + 1))  # of the token that begins here; 0 once it has been merged away
    before = list(range(-1, n - 1))
    heap = [(ranks[piece[i:i + 2]], i, i + 1, i + 2) for i in range(n - 1) if piece[i:i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, a, b, c = heapq.heappop(heap)
        if end[a] != b or b >= n or end[b] != c:
            continue  # one of the two has changed since
        end[a], end[b] = c, 0
        if c < n:
            before[c] = a
            if (r := ranks.get(piece[a:end[c]])) is not None:
                heapq.heappush(heap, (r, a, c, end[c]))
        if (p := before[a]) >= 0 and (r := ranks.get(piece[p:c])) is not None:
            heapq.heappush(heap, (r, p, a, c))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


def _merge_rows(ranks):
    """Ids of every piece, bucket by bucket; rows arrive sorted by bucket and only one bucket's pieces are remembered."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bucket, known = ranks.value, None, {}
        for b in batches:
            for row in b.to_pylist():
                if row["bucket"] != bucket:
                    bucket, known = row["bucket"], {}
                ids = []
                for piece in unzip_pieces(row["pieces"]):
                    got = known.get(piece)
                    if got is None:
                        got = known[piece] = merge(piece, table)
                    ids.append(got)
                yield pa.RecordBatch.from_arrays([pa.array([row["block"]]), pa.array([row["at"]], pa.binary()),
                                                  pa.array([zip_ints(np.fromiter(map(len, ids), np.uint32, len(ids)))], pa.binary()),
                                                  pa.array([zip_ints(np.fromiter(chain.from_iterable(ids), np.uint32))], pa.binary())],
                                                 names=["block", "at", "sizes", "ids"])
        known.clear()
        give_back()
    return run


def _lay_out(schema: pa.Schema):
    def run(blocks: pa.Table, pieces: pa.Table) -> pa.Table:
        raw = [[unzip_ints(x) for x in pieces.column(c).to_pylist()] for c in ("at", "sizes", "ids")]
        at, n, flat = (np.concatenate(x) if x else np.empty(0, np.uint32) for x in raw)
        start, size = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        size[at] = n
        start[at] = np.cumsum(n, dtype=np.int64) - n
        flat, out = flat.astype(np.int32), []
        for docs, places in zip(blocks.column("docs").to_pylist(), blocks.column("places").to_pylist()):
            seq, done = unzip_ints(places), 0
            for i in range(0, len(docs), 256):
                some = docs[i:i + 256]
                counts = np.cumsum([0] + [d["n"] for d in some])
                ids, sizes = ragged(flat, start, size, seq[done:done + counts[-1]])
                done += counts[-1]
                ends = np.concatenate([[0], np.cumsum(sizes)])[counts]
                out.append(pa.RecordBatch.from_arrays([pa.array([d["doc_id"] for d in some], schema.field(0).type),
                                                       pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))], schema=schema))
        give_back()  # what stays is the result
        return pa.Table.from_batches(out, schema)
    return run


def encode(docs: DataFrame, rank_path: str, pattern: str, block: int = SIZE) -> DataFrame:
    """(doc_id, ids array<int>) of every row of ``docs`` (doc_id, text).

    Null and empty texts have no ids. Repeated rows and null doc_ids are rows like any other. Other columns are not read. No
    special tokens: their strings are ordinary text.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(rank_path))

    def find(text: str) -> list[str]:
        return splitter(pattern).findall(text)

    blocks = packed(docs, find, F.lit(False), block)
    merged = (by_bucket(blocks).select("block", "bucket", "pieces", "at").repartition("bucket").sortWithinPartitions("bucket")
              .mapInArrow(_merge_rows(ranks), "block bigint, at binary, sizes binary, ids binary"))
    schema = pa.schema([("doc_id", arrow_type(kind)), ("ids", pa.list_(pa.int32()))])
    return (blocks.select("block", "docs", "places").groupBy("block").cogroup(merged.groupBy("block"))
            .applyInArrow(_lay_out(schema), f"doc_id {kind}, ids array<int>"))


def decode(encoded: DataFrame, rank_path: str) -> DataFrame:
    """Adds ``decoded`` (binary) to a frame with ``ids``; null ids give no bytes, an id outside the vocabulary fails the task."""
    ranks = read_ranks(rank_path)
    tokens = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    table = encoded.sparkSession.sparkContext.broadcast(tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = np.fromiter(map(len, table.value), np.int64, len(table.value))
        flat, start = np.frombuffer(b"".join(table.value), np.uint8), np.cumsum(size) - size
        for b in batches:
            for i in range(0, b.num_rows, 64):
                part = b.slice(i, 64)
                ids = part.column("ids").fill_null([]) if part.column("ids").null_count else part.column("ids")
                text, sizes = ragged(flat, start, size, ids.flatten().to_numpy())
                counts = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())])
                ends = np.concatenate([[0], np.cumsum(sizes)])[counts]
                decoded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), part.num_rows, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(text)])
                yield pa.RecordBatch.from_arrays([*part.columns, decoded.cast(pa.binary())], names=[*b.schema.names, "decoded"])
        give_back()

    return encoded.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields) + ", decoded binary")


def tokenizer() -> tuple[str, str]:
    """The rank file and the splitting pattern of the registered query."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def digests(docs: DataFrame) -> DataFrame:
    path, pattern = tokenizer()
    return decode(encode(docs, path, pattern), path).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))

"""SentencePiece encoding and decoding with a given BPE model, by vectorised merge rounds.

The model's pieces never hold a space mark after another character, so a text falls into words (space marks and what follows them)
that are merged on their own. A task meets each distinct word once for as long as it remembers it. The words it does not know
yet are merged together: one flat array of symbols, the least rank of an adjacent pair in each word's segment, all
leftmost pairs of that rank merged at once, the array compacted, until no word has a pair left. A round looks up only the pairs
that the last one made.

Merging all pairs of a rank at once gives what one at a time, leftmost first, gives, unless a merged piece can at once be part of a
pair that comes before the rest of its rank. Such pieces are known from the model (``Model.eager``); words about to make one
merge only their first pair in that round. Words longer than ``LONG`` symbols, for which rounds over the whole word would take
quadratic time, are merged with a queue of pairs instead.

Texts are independent, so nothing is shuffled: a lost task is run again. A task holds a slice of rows, a segment of one text, and at most
``KNOWN`` words.
"""

from __future__ import annotations

import codecs
import heapq
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthgrid.llm.blocks import arrow_type, ragged
from monthgrid.llm.words import give_back, parts

#: How the model writes a space.
MARK = "▁"
#: Words of more symbols are merged with a queue.
LONG = 256
#: Distinct words that a task remembers; it begins anew beyond that.
KNOWN = 1 << 18
#: Characters of one text that are cut into words at once.
SEGMENT = 1 << 20
_NONE = np.int64(1) << 40
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_EDGE = re.compile(f"[^{MARK}]{MARK}")
# The library replaces every byte that does not belong to a character on its own.
codecs.register_error("monthgrid-each-byte", lambda e: ("�", e.start + 1))


class Model(NamedTuple):
    """A BPE model as arrays. Symbols are piece ids; characters that only occur inside pieces have numbers beyond them."""

    char: np.ndarray  # code point to symbol, -1 for none
    pairs: np.ndarray  # sorted keys ``left * symbols + right`` of the pairs that form a piece
    made: np.ndarray  # the piece of each pair
    pair: dict[int, int]  # the same as a dictionary
    rank: np.ndarray  # of each piece: 0 for the best score; equal scores have equal ranks
    eager: np.ndarray  # pieces that may at once be part of a pair of no higher rank
    byte: np.ndarray  # the id of each byte
    text: list[bytes]  # what an id stands for
    marked: np.ndarray  # ids that begin with the space mark
    end: int
    symbols: int


@lru_cache(maxsize=2)
def read_model(path: str) -> Model:
    """The model of a file; only BPE models with byte fallback, an identity normaliser and a space in front are supported."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    kind, train, norm = pb.ModelProto.SentencePiece.Type, proto.trainer_spec, proto.normalizer_spec
    known = {kind.Value(k) for k in ("NORMAL", "UNKNOWN", "CONTROL", "BYTE")}
    if (train.model_type != pb.TrainerSpec.BPE or not train.byte_fallback or train.treat_whitespace_as_suffix or norm.precompiled_charsmap
            or not norm.add_dummy_prefix or norm.remove_extra_whitespaces or not norm.escape_whitespaces or any(p.type not in known for p in proto.pieces)):
        raise ValueError("not a BPE model with byte fallback, identity normalisation and a space in front")
    n = len(proto.pieces)
    normal = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kind.Value("NORMAL")}
    if any(MARK in p.lstrip(MARK) for p in normal):
        raise ValueError("a piece holds a space mark after another character")
    symbol = dict(normal)
    for p in normal:
        for c in p:
            symbol.setdefault(c, len(symbol) - len(normal) + n)
    scores = np.array([p.score for p in proto.pieces], np.float32)
    rank = np.searchsorted(np.unique(-scores), -scores).astype(np.int64)
    size, pairs, eager = n + len(symbol) - len(normal), {}, np.zeros(n, bool)
    for whole, i in normal.items():
        for k in range(1, len(whole)):
            left, right = symbol.get(whole[:k]), symbol.get(whole[k:])
            for part in (left, right):
                if part is not None and part < n and rank[part] >= rank[i]:
                    eager[part] = True
            if left is not None and right is not None:
                pairs[left * size + right] = i
    keys = np.array(sorted(pairs), np.int64)
    char = np.full(0x110000, -1, np.int64)
    byte, text = np.zeros(256, np.int64), []
    for s, i in symbol.items():
        if len(s) == 1:
            char[ord(s)] = i
    for i, p in enumerate(proto.pieces):
        if p.type == kind.Value("BYTE"):
            value = int(p.piece[3:5], 16)  # <0x0A>
            byte[value] = i
            text.append(bytes([value]))
        else:
            text.append({kind.Value("CONTROL"): b"", kind.Value("UNKNOWN"): train.unk_surface.encode()}.get(p.type, p.piece.replace(MARK, " ").encode()))
    marked = np.array([p.type == kind.Value("NORMAL") and p.piece.startswith(MARK) for p in proto.pieces], bool)
    return Model(char, keys, np.array([pairs[k] for k in keys.tolist()], np.int64), pairs, rank, eager, byte, text, marked, train.eos_id, size)


def _pair_ranks(model: Model, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rank, piece) of each adjacent pair; _NONE where the two form no piece."""
    key = np.where((left < 0) | (right < 0), -1, left * model.symbols + right)
    at = np.minimum(np.searchsorted(model.pairs, key), len(model.pairs) - 1)
    piece = model.made[at]
    return np.where(model.pairs[at] == key, model.rank[piece], _NONE), piece


def merge_rounds(model: Model, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merges the symbols of many words at once. ``word`` numbers each symbol's word, ascending. Returns both, merged."""
    done_sym, done_word = [], []
    rank, piece = np.full(len(sym), _NONE), np.zeros(len(sym), np.int64)
    fresh = np.arange(len(sym))  # whose pair with the next symbol is new in this round
    while len(sym):
        fresh = fresh[fresh < len(sym) - 1]
        rank[fresh], piece[fresh] = _pair_ranks(model, sym[fresh], sym[fresh + 1])
        edge = word[1:] != word[:-1]
        rank[:-1][edge] = _NONE
        rank[-1] = _NONE
        start = np.concatenate([[0], np.flatnonzero(edge) + 1])
        size = np.diff(np.append(start, len(sym)))
        least = np.minimum.reduceat(rank, start)
        ended = least == _NONE
        hit = rank == np.repeat(np.where(ended, -1, least), size)
        if ended.any():
            over = np.repeat(ended, size)
            done_sym.append(sym[over])
            done_word.append(word[over])
        begins = hit & ~np.concatenate([[False], hit[:-1]])
        if (hit & ~begins).any():  # of pairs that overlap, every second one from the left
            place = np.arange(len(sym))
            hit &= (place - np.maximum.accumulate(np.where(begins, place, 0))) % 2 == 0
        at = np.flatnonzero(hit)
        hasty = model.eager[piece[at]]
        if hasty.any():
            whose = np.searchsorted(start, at, "right") - 1
            first = np.concatenate([[True], whose[1:] != whose[:-1]])
            at = at[first | ~np.isin(whose, whose[hasty])]
        sym[at] = piece[at]
        keep = ~over if ended.any() else np.ones(len(sym), bool)
        keep[at + 1] = False
        at = (np.cumsum(keep) - 1)[at]
        sym, word, rank, piece = sym[keep], word[keep], rank[keep], piece[keep]
        fresh = np.concatenate([at, at[at > 0] - 1])
    sym, word = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (done_sym, done_word))
    order = np.argsort(word, kind="stable")
    return sym[order], word[order]


def merge_queue(model: Model, sym: np.ndarray) -> np.ndarray:
    """The same for one long word: a queue of pairs by rank and place; near-linear time."""
    n, sym = len(sym), sym.copy()
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    rank, piece = _pair_ranks(model, sym[:-1], sym[1:])
    at = np.flatnonzero(rank < _NONE)
    queue = [(r, i, int(a), int(b), p) for r, i, a, b, p in zip(rank[at].tolist(), at.tolist(), sym[at], sym[at + 1], piece[at].tolist())]
    heapq.heapify(queue)
    sym = sym.tolist()
    while queue:
        _, i, a, b, p = heapq.heappop(queue)
        j = after[i]
        if not alive[i] or sym[i] != a or j >= n or sym[j] != b:
            continue  # one of the two has changed since
        sym[i], alive[j] = p, False
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for x, y in ((before[i], i), (i, after[i])):
            if x >= 0 and y < n and sym[x] >= 0 and sym[y] >= 0 and (q := model.pair.get(sym[x] * model.symbols + sym[y])) is not None:
                heapq.heappush(queue, (int(model.rank[q]), x, sym[x], sym[y], q))
    return np.array([s for s, live in zip(sym, alive) if live], np.int64)


def merged(model: Model, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words one after the other, how many each has)."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    point = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    sym, word = model.char[point], np.repeat(np.arange(len(words)), size)
    # a character without a symbol keeps its code point until its bytes take its place
    sym = np.where(sym < 0, -1 - point.astype(np.int64), sym)
    long = np.repeat(size > LONG, size)
    out = [merge_rounds(model, sym[~long], word[~long])]
    for k in np.flatnonzero(size > LONG).tolist():
        one = merge_queue(model, sym[word == k])
        out.append((one, np.full(len(one), k)))
    sym, word = (np.concatenate(x) for x in zip(*out))
    order = np.argsort(word, kind="stable")
    sym, word = sym[order], word[order]
    odd = np.flatnonzero((sym < 0) | (sym >= len(model.text)))
    if len(odd):
        repeat, spelt = np.ones(len(sym), np.int64), {}
        for i in odd.tolist():
            spelt[i] = chr(-1 - sym[i] if sym[i] < 0 else np.flatnonzero(model.char == sym[i])[0]).encode()
            repeat[i] = len(spelt[i])
        first = np.cumsum(repeat) - repeat
        sym, word = np.repeat(sym, repeat), np.repeat(word, repeat)
        for i, raw in spelt.items():
            sym[first[i]:first[i] + len(raw)] = model.byte[np.frombuffer(raw, np.uint8)]
    return sym.astype(np.int32), np.bincount(word, minlength=len(words))


def segments(text: str, limit: int = SEGMENT) -> Iterator[str]:
    """A text in parts of about ``limit`` characters that begin where a word begins."""
    at = 0
    while (edge := _EDGE.search(text, at + limit)) is not None:
        yield text[at:edge.end() - 1]
        at = edge.end() - 1
    yield text[at:]


class _Store:
    """Ids of the words met so far; word 0 is the end of a text."""

    def __init__(self, model: Model):
        self.model, self.known = model, defaultdict()
        self.clear()

    def clear(self):
        self.known.default_factory = None  # breaks the cycle that would keep the words until Python next looks for cycles
        self.known = defaultdict()
        self.known.default_factory = self.known.__len__
        self.known[None] = 0
        self.flat, self.used = np.array([self.model.end], np.int32), 1
        self.size, self.start = np.ones(1, np.int64), np.zeros(1, np.int64)

    def met(self, text: str) -> np.ndarray:
        """The numbers of a text's words."""
        return np.fromiter(map(self.known.__getitem__, _WORD.findall(text)), np.int64)

    def ids_of(self, words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the numbered words, one after the other, and how many each array of words has."""
        if len(self.known) > len(self.size):
            self.learn()
        ids, size = ragged(self.flat, self.start, self.size, np.concatenate(words))
        total = np.concatenate([[0], np.cumsum(size)])
        return ids, np.diff(total[np.cumsum([0, *map(len, words)])])

    def forget(self):
        if len(self.known) > KNOWN:
            self.clear()

    def ids(self, text: str) -> list[np.ndarray]:
        """The ids of a text of any length, a segment at a time."""
        out = []
        for part in segments(text):
            self.forget()
            out.append(self.ids_of([self.met(part)])[0])
        return out

    def learn(self):
        flat, size = merged(self.model, list(islice(self.known, len(self.size), None)))
        if self.used + len(flat) > len(self.flat):  # room for as many again, so that each id is moved a few times only
            self.flat = np.concatenate([self.flat, np.empty(self.used + len(flat), np.int32)])
        self.flat[self.used:self.used + len(flat)] = flat
        self.start = np.concatenate([self.start, self.used + np.cumsum(size) - size])
        self.size, self.used = np.concatenate([self.size, size]), self.used + len(flat)


def _encode(path: str, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = _Store(read_model(path))
        end = store.flat[:1]
        for b in parts(batches, 64):
            texts = [MARK + t.replace(" ", MARK) if t else "" for t in b.column(1).to_pylist()]
            if sum(map(len, texts)) <= SEGMENT:
                # meet the words of the whole slice before any is merged, so that they are merged together
                store.forget()
                flat, sizes = store.ids_of([np.append(store.met(t), 0) for t in texts])
            else:
                rows = [np.concatenate([*(store.ids(t) if t else []), end]) for t in texts]
                flat, sizes = np.concatenate(rows), list(map(len, rows))
            ids = pa.LargeListArray.from_arrays(pa.array(np.cumsum([0, *sizes])), pa.array(flat))
            yield pa.RecordBatch.from_arrays([b.column(0), ids.cast(schema.field(1).type)], schema=schema)
        store.clear()
        give_back()
    return run


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids array<int>) of every row of ``docs`` (doc_id, text), as the library encodes with an end id and without sampling.

    Null and empty texts have the end id alone. Repeated rows and null doc_ids are rows like any other. Other columns are not
    read. ``model_path`` is read by each task and must exist on every machine.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = pa.schema([("doc_id", arrow_type(kind)), ("ids", pa.list_(pa.int32()))])
    return (docs.select("doc_id", F.col("text").cast("string").alias("text"))
            .mapInArrow(_encode(model_path, schema), f"doc_id {kind}, ids array<int>"))


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """Adds ``decoded`` (string) to a frame with ``ids`` (array<int>), as the library decodes them.

    Control ids give nothing, the space in front of the first piece is dropped, bytes that form no character become U+FFFD each.
    Null ids give the empty text; an id outside the model fails the task.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = read_model(model_path)
        size = np.fromiter(map(len, model.text), np.int64, len(model.text))
        flat, start = np.frombuffer(b"".join(model.text), np.uint8), np.cumsum(size) - size
        for b in parts(batches, 64):
            ids = b.column("ids")
            ids = ids.fill_null([]) if ids.null_count else ids
            each = ids.flatten().to_numpy()
            if len(each) and (each.min() < 0 or each.max() >= len(size)):
                raise ValueError("an id outside the model")
            raw, sizes = ragged(flat, start, size, each)
            count = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())])
            edge = np.concatenate([[0], np.cumsum(sizes)])[count]
            out = []
            for i in range(b.num_rows):
                row, text = each[count[i]:count[i + 1]], raw[edge[i]:edge[i + 1]].tobytes()
                first = int(np.argmax(size[row] > 0)) if len(row) else 0
                if len(row) and model.marked[row[first]]:
                    text = text[1:]
                out.append(text.decode("utf-8", "monthgrid-each-byte"))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], names=[*b.schema.names, "decoded"])
        give_back()

    return encoded.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields) + ", decoded string")


def model_path() -> str:
    """The model of the registered query."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = model_path()
    coded = decode(encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), path), path)
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))

"""Language-model scoring by a hierarchical Pitman-Yor model.

Words are the tokens. Each word before (the end of a text, for its first word) has a restaurant of the words after it; all of
them share a parent, the word restaurant, whose customers are their tables. Its new tables' words are drawn from a
spelling model: restaurants of characters, one for each context of up to three characters before, all contexts that end alike
sharing the parent restaurant of the shorter context, down to a uniform choice. As in the base score, all words outside the
training texts are one unknown word: in the word restaurant it has the mass of a new table times that of all spellings not
seen, so after any word the probabilities of all known words and this one add up to 1.

Seating is sampled by Gibbs sweeps. A sweep reseats every pair's and every word's customers one after the other, given the tables
of all others and the parent of the sweep before (beyond 64 customers in groups that grow by a sixteenth, rounded at random).
Tables are customers of the parent, those reseat likewise and send their tables on to their parents. After ``BURN`` sweeps,
``KEEP`` sweeps are kept and their predictive probabilities averaged.

Words and pairs are as many as the corpus brings: they stay in the bucket of the pair's second word (``blocks``), each bucket
samples its own. A context's tables lie in many buckets; its home, found by a hash, adds them up each sweep and tells the buckets
that need them. Contexts that had no pair twice keep their tables and are told once. Characters' contexts are cut to classes (64,
as for ``perplexity``), symbols are bytes: at most ``64**3 * 257`` kinds of customers whatever the corpus, so the spelling model is
broadcast. A word's and a pair's part of the score go back to the blocks that hold them by position, once for each block.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthgrid.llm import words as W
from monthgrid.llm.blocks import (arrow_type, distinct, kept_by, packed, pairs_of, ragged, unzip_counts, unzip_ints, unzip_longs, unzip_pieces, unzip_steps,
                                  with_pairs, zip_counts, zip_ints, zip_longs, zip_pieces, zip_steps)
from monthgrid.llm.labels import remainder

BURN, KEEP = 2, 3
THETA = 1.0
SYMBOLS, END, DEPTH = 257, 256, 3
EXACT = 64
SMOOTH = 0.1

#: Class of each byte before a character; 0 stands for what is before the word.
CLASS = np.full(256, 58, np.uint32)
CLASS[0x61:0x7B] = np.arange(1, 27)
CLASS[0x41:0x5B] = 27 + np.arange(26) % 13
CLASS[0x30:0x3A] = 53
CLASS[list(W.SPACES)] = 54
CLASS[0x0A] = 55
CLASS[list(b".,;:!?'\"()-")] = 56
CLASS[list(b"#*$%&|<>")] = 57
CLASS[0x80:] = 59 + np.arange(128) % 5


def tokens(text: str) -> list[bytes]:
    """Words in lower case (A-Z), then the end, which is the empty word."""
    return [*text.encode().lower().split(), b""]


def seat(customers: np.ndarray, pull: np.ndarray, base: np.ndarray, discount: float, seed: np.ndarray) -> np.ndarray:
    """Tables of each dish after seating its customers in turn.

    ``pull`` is the weight of a new table from the tables of other dishes, (strength + discount * tables) * base; ``seed`` decides
    the draws. A dish with customers has a table at least, and no more tables than customers.
    """
    order = np.argsort(-customers.astype(np.int16 if customers.max(initial=0) < 1 << 15 else np.int64), kind="stable")  # short numbers go by their digits
    c, pull, base, seed = customers[order], pull[order], base[order], seed[order]
    t = (c > 0).astype(float)
    j, some = 1, int(np.searchsorted(-c, -1, "left"))
    while some:
        step = 1 if j < EXACT else j // 16
        n = np.minimum(step, c[:some] - j)
        new = pull[:some] + discount * t[:some] * base[:some]
        u = (W.mix(seed[:some] ^ W.U(j * 0x9E3779B97F4A7C15 % 2**64)) >> W.U(11)).astype(float) / 2.0**53
        t[:some] += np.floor(n * new / (new + j - discount * t[:some]) + u)
        j += step
        some = int(np.searchsorted(-c, -j, "left"))
    out = np.empty(len(t))
    out[order] = np.minimum(t, c)
    return out


def discount(once: float, twice: float) -> float:
    """The usual estimate from how many dishes were ordered once and twice."""
    return min(0.95, max(0.1, once / (once + 2 * twice))) if once + twice else 0.5


def spell(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context code, symbol, word number) of every character of every word and its end."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), size + 1)
    first = np.cumsum(size + 1) - size - 1
    at = np.arange(len(owner)) - first[owner]
    symbol = np.full(len(owner), END, np.int64)
    symbol[at < size[owner]] = np.frombuffer(b"".join(words), np.uint8)
    kind = np.concatenate([CLASS.astype(np.int64), [0]])[symbol]
    context = np.zeros(len(owner), np.int64)
    for k in range(1, DEPTH + 1):
        before = np.concatenate([np.zeros(k, np.int64), kind])[:len(owner)]
        context |= np.where(at >= k, before, 0) << 6 * (k - 1)
    return context, symbol, owner


def coded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct codes, context * 512 + symbol, of all characters; the place among them and the word number of every character."""
    context, symbol, owner = spell(words)
    return *distinct(context << 9 | symbol), owner


class Spelling:
    """Predictive probabilities of the character restaurants, ready for lookup: full tables up to contexts of two characters,
    sorted codes for the seen pairs of a three-character context and a symbol, and each such context's weight of its parent."""

    def __init__(self, codes: np.ndarray, customers: np.ndarray, earlier: Spelling | None, seed: int):
        """``codes`` are context * 512 + symbol, sorted. Reseats all restaurants given the earlier sweep's probabilities."""
        level = DEPTH
        counts, seated = {DEPTH: (codes, customers.astype(np.int64))}, {}
        while level >= 0:  # from the longest contexts to the shortest: customers, tables, the parent's customers
            code, c = counts[level]
            context = code >> 9
            base = earlier.parent(level, code) if earlier else np.full(len(code), 1 / SYMBOLS)
            d = discount((c == 1).sum(), (c == 2).sum())
            room, where = np.unique(context, return_inverse=True)
            others = np.bincount(where, c)[where] ** d if len(c) else c  # as many tables as the restaurant may be expected to have
            t = seat(c, (THETA + d * others) * base, base, d, W.mix(code.astype(W.U) ^ W.U(seed * 8 + level)))
            seated[level] = (code, c, t, d, room, where)
            if level:
                short = (code >> 9 & ((1 << 6 * (level - 1)) - 1)) << 9 | code & 511
                up, to = np.unique(short, return_inverse=True)
                counts[level - 1] = (up, np.bincount(to, t).astype(np.int64))
            level -= 1
        self.levels = []  # of each level the seen pairs with their own share, and the rooms with their parent's share
        for level in range(DEPTH + 1):
            code, c, t, d, room, where = seated[level]
            total, tables = (np.bincount(where, x) if len(code) else np.zeros(0) for x in (c, t))
            own = (c - d * t) / (THETA + total[where]) if len(code) else np.zeros(0)
            self.levels.append((code.astype(np.int32), own, room.astype(np.int32), (THETA + d * tables) / (THETA + total)))
        self._fill()

    def _fill(self):
        self.full = []
        for level, (code, own, room, weight) in enumerate(self.levels):
            share = np.ones(1 << 6 * level)
            share[room] = weight
            if level == DEPTH:
                self.codes, self.share = code, share
                self.seen = own + share[code >> 9] * self.full[-1].ravel()[code & ((1 << 6 * (level - 1) + 9) - 1)]
            else:
                rooms = np.arange(1 << 6 * level)
                p = share[:, None] * (self.full[-1][rooms & ((1 << 6 * (level - 1)) - 1)] if level else np.full((1, 512), 1 / SYMBOLS))
                p.ravel()[code] += own
                self.full.append(p)

    def __getstate__(self):
        """Tasks get the seen pairs only and fill the tables themselves."""
        return self.levels

    def __setstate__(self, levels):
        self.levels = levels
        self._fill()

    def parent(self, level: int, code: np.ndarray) -> np.ndarray:
        """Probability of each symbol in the next shorter context."""
        return self.full[level - 1].ravel()[code & ((1 << 6 * (level - 1) + 9) - 1)] if level else np.full(len(code), 1 / SYMBOLS)

    def probability(self, context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        code = context << 9 | symbol
        p = self.share[context] * self.parent(DEPTH, code)
        if len(self.codes):
            i = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            p = np.where(self.codes[i] == code, self.seen[i], p)
        return p

    def words(self, spelt: tuple) -> np.ndarray:
        """Probability of each spelt word, its end included."""
        context, symbol, owner = spelt
        return self.coded(*distinct(context << 9 | symbol), owner)

    def coded(self, code: np.ndarray, at: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """The same from ``coded``: each distinct code is looked up once."""
        return np.exp(np.bincount(owner, np.log(self.probability(code >> 9, code & 511))[at])) if len(owner) else np.zeros(0)


def _hash(words: list[bytes]) -> np.ndarray:
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size)
    return W.hash_spans(np.frombuffer(b"".join(words) + b"\0", np.uint8), ends - size, ends)


def _merged(held: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """(pair, times) of each distinct pair, sorted."""
    pair, times = (np.concatenate(x) for x in zip(*held))
    code, at = distinct(pair)
    return code, np.bincount(at, times, len(code)).astype(np.int64)


VOCABULARY = ("bucket int, words binary, counts binary, sizes binary, contexts binary, context_at binary, own binary, times binary, "
              "n bigint, v bigint, once bigint, twice bigint, pairs_once bigint, pairs_twice bigint, block bigint, at binary, word_at binary, pair_at binary")
_VOCABULARY = pa.schema([(c, {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}[t]) for c, t in (x.split() for x in VOCABULARY.split(", "))])
#: Bytes and pairs that a task gathers before it passes or merges them.
_GATHERED, _HELD = 4 << 20, 1 << 20


def _gathered(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in batches of a few MB."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row.values() if isinstance(v, bytes))
        if size > _GATHERED:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _places(known: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Place of each number in the sorted ``known``, -1 if it is not there."""
    if not len(known):
        return np.full(len(asked), -1)
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    return np.where(known[at] == asked, at, -1)


def _set(held: list[np.ndarray]) -> np.ndarray:
    s = np.sort(np.concatenate(held))
    return s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s


def _bucket_rows(bucket: int, known: dict, parts: list[dict], contexts: np.ndarray, order: int) -> Iterator[dict]:
    """The row of a bucket's words and pairs, then for each block where its words and pairs are in it."""
    words = sorted(known)
    place = np.empty(max(known.values()) + 1, np.int64)
    place[np.fromiter(map(known.__getitem__, words), np.int64, len(words))] = np.arange(len(words))
    known.clear()
    hashes = _hash(words)
    contexts = _set([contexts, hashes])

    def pairs(part, ids):
        at = _places(contexts, unzip_longs(part["contexts"]))[unzip_steps(part["context_at"])]
        return np.where(at < 0, -1, np.repeat(ids.astype(np.int64), unzip_ints(part["sizes"])) * len(contexts) + at)

    c, merged, held, found = np.zeros(len(words), np.int64), [(np.zeros(0, np.int64),) * 2], 0, 0
    for part in parts:
        part["ids"] = ids = place[part["ids"]].astype(np.int32)
        c[ids] += unzip_ints(part.pop("learnt"))
        if order == 2:
            times, code = unzip_ints(part.pop("times")).astype(np.int64), pairs(part, ids)
            found += len(code)
            if found < _HELD:  # few enough to keep until all are merged
                part["pairs"] = code
            some = np.flatnonzero(times)
            merged.append((code[some], times[some]))
            held += len(some)
            if held > max(_HELD, 2 * len(merged[0][0])):
                merged, held = [_merged(merged)], 0
    pair, times = _merged(merged)
    word, context = np.divmod(pair, len(contexts))
    sizes = np.bincount(word, minlength=len(words))
    first = sizes if order == 2 else c  # the customers of the word restaurant while each pair has one table
    yield dict(bucket=bucket, words=zip_pieces(words), counts=zip_counts(c), sizes=zip_ints(sizes), contexts=zip_longs(contexts), context_at=zip_ints(context),
               own=zip_ints(np.searchsorted(contexts, hashes)), times=zip_counts(times), n=int(c.sum()),
               **{k: int(x.sum()) for k, x in (("v", c > 0), ("once", first == 1), ("twice", first == 2), ("pairs_once", times == 1), ("pairs_twice", times == 2))})
    for part in parts:
        code = part.pop("pairs") if "pairs" in part else pairs(part, part["ids"])
        yield dict(bucket=bucket, block=part["block"], at=part["at"], word_at=zip_steps(part["ids"]), pair_at=zip_steps(_places(pair, code) + 1))


def _vocabulary(order: int):
    """Distinct words of each bucket with their training counts and their pairs with the word before, and where each block's words
    and pairs are among these (a pair's place from 1 on, 0 if it is not learnt); rows arrive sorted by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, known, held, contexts, more, numbers = None, {}, [], np.zeros(0, W.U), [], itertools.count()

        def out():
            return _gathered(_bucket_rows(bucket, known, held, np.concatenate([contexts, *more]), order), _VOCABULARY)

        for b in W.parts(batches, 1):  # a block's part at a time
            row = b.to_pylist()[0]
            if row["bucket"] != bucket:
                if held:
                    yield from out()
                bucket, known, held, contexts, more, numbers = row["bucket"], {}, [], np.zeros(0, W.U), [], itertools.count()
            row["ids"] = np.fromiter(map(known.setdefault, unzip_pieces(row.pop("pieces")), numbers), np.int32)
            if order == 2:
                learnt = np.zeros(int.from_bytes(row["contexts"][:8], "little"), bool)
                learnt[unzip_steps(row["context_at"])[unzip_ints(row["times"]) > 0]] = True
                more.append(unzip_longs(row["contexts"])[learnt])
                if sum(map(len, more)) > max(_HELD, 2 * len(contexts)):
                    contexts, more = _set([contexts, *more]), []
            held.append(row)
        if held:
            yield from out()
    return run


def _tables(c, probability, total_tables, d, seed_hash, sweep):
    return seat(c, (THETA + d * total_tables) * probability, probability, d, W.mix(seed_hash ^ W.U(sweep + 1)))


class _Bucket:
    """The words of a bucket, their pairs with the word before, and what the homes of the contexts say about all buckets."""

    def __init__(self, row: dict, homes: int):
        self.counts = unzip_counts(row["counts"]).astype(np.int64)
        self.contexts, self.at, self.times = unzip_longs(row["contexts"]), unzip_ints(row["context_at"]), unzip_counts(row["times"]).astype(np.int64)
        self.word = np.repeat(np.arange(len(self.counts)), unzip_ints(row["sizes"]))
        self.own = unzip_ints(row["own"])  # the words as contexts
        self.hash = self.contexts[self.own]
        self.home = (self.contexts % W.U(homes)).astype(np.uint16 if homes < 1 << 16 else np.int64)  # short numbers are put in order by their digits
        self.big = np.flatnonzero(self.times > 1)  # a pair seen once keeps its one table
        self.tables, self.customers = np.zeros((2, len(self.contexts)))  # of each context's restaurant in all buckets
        if row.get("first"):
            self._tell(row["first"], np.arange(len(self.contexts)), tables=self.tables, customers=self.customers)
        asks = np.zeros(len(self.contexts), bool)
        asks[self.at[self.big]] = True
        asks[self.own[(self.customers > self.tables)[self.own]]] = True
        self.asks = np.flatnonzero(asks)  # the contexts whose tables can change and matter here
        if row.get("replies"):
            self._tell(row["replies"], self.asks, tables=self.tables)

    def _by_home(self, which: np.ndarray) -> np.ndarray:
        return which[np.argsort(self.home[which], kind="stable")]

    def _tell(self, replies: list[dict], which: np.ndarray, **known: np.ndarray):
        """Adds what the homes say about the contexts they were asked for."""
        order, replies = self._by_home(which), sorted(replies, key=lambda x: x["home"])
        for name, x in known.items():
            x[order] += np.concatenate([unzip_counts(r[name]) for r in replies])

    def messages(self, which: np.ndarray, tables: np.ndarray, customers: np.ndarray) -> list[dict]:
        """To each home those of ``which`` contexts that it keeps, with this bucket's tables and customers of each."""
        order = self._by_home(which)
        parts = np.split(order, np.flatnonzero(np.diff(self.home[order])) + 1)
        return [{"home": int(self.home[i[0]]), "contexts": zip_longs(self.contexts[i]), "tables": zip_counts(tables[i]), "customers": zip_counts(customers[i])} for i in parts if len(i)]

    def first(self) -> list[dict]:
        """All contexts, with a table for each pair."""
        n = len(self.contexts)
        return self.messages(np.arange(n), np.bincount(self.at, minlength=n), np.bincount(self.at, self.times, n))

    def more(self, tables: np.ndarray) -> list[dict]:
        """The contexts that can change, with the tables beyond one for each pair."""
        n = len(self.contexts)
        return self.messages(self.asks, np.bincount(self.at[self.big], tables[self.big] - 1, n), np.zeros(n))


def _word(c, t, spelling, d, total, tables):
    """Probability of each known word in the word restaurant."""
    return (np.maximum(c - d * t, 0) + (THETA + d * tables) * spelling) / (THETA + total)


_MESSAGE = pa.struct([("home", pa.int32()), ("contexts", pa.binary()), ("tables", pa.binary()), ("customers", pa.binary())])
_STATE = pa.schema([("bucket", pa.int32()), ("seated", pa.binary()), ("at_tables", pa.binary()), ("pair_tables", pa.binary()), ("kept", pa.list_(pa.binary())),
                    ("codes", pa.binary()), ("code_n", pa.binary()), ("total", pa.int64()), ("tables", pa.int64()), ("messages", pa.list_(_MESSAGE))])
STATE = ("bucket int, seated binary, at_tables binary, pair_tables binary, kept array<binary>, codes binary, code_n binary, total bigint, tables bigint, "
         "messages array<struct<home:int,contexts:binary,tables:binary,customers:binary>>")


def _sweep(known, d: float, d_pair: float, sweep: int, burn: int, order: int, homes: int):
    """Reseats the pairs and the words of each bucket.

    ``kept`` collects, for each kept sweep, the words' customers and tables and, a sweep later, the tables of the words as contexts.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, total, tables = known.value
        for b in W.parts(batches, 1):  # a bucket at a time
            for row in b.to_pylist():
                k = _Bucket(row, homes)
                code, at, owner = spelt = coded(unzip_pieces(row["words"]))
                kept, sums = list(row.get("kept") or ()), np.zeros(len(k.times))
                if sweep:
                    spelling, sums = model.coded(*spelt), unzip_counts(row["pair_tables"]).astype(float)
                    word, context = k.word[k.big], k.at[k.big]
                    p = _word(unzip_counts(row["seated"]).astype(float), unzip_counts(row["at_tables"]).astype(float), spelling, d, total, tables)[word]
                    pair_t = np.ones(len(k.times))
                    pair_t[k.big] = seat(k.times[k.big], (THETA + d_pair * k.tables[context]) * p, p, d_pair, W.mix(k.contexts[context] ^ W.mix(k.hash[word] ^ W.U(sweep + 1))))
                    c = np.bincount(k.word, pair_t, len(k.counts)).astype(np.int64) if order == 2 else k.counts
                    t = _tables(c, spelling, tables, d, k.hash, sweep)
                    if sweep > burn + 1:
                        kept.append(zip_counts(k.tables[k.own]))
                else:
                    pair_t = np.ones(len(k.times))
                    c = np.bincount(k.word, pair_t, len(k.counts)).astype(np.int64) if order == 2 else k.counts
                    t = (c > 0).astype(float)
                if sweep > burn:
                    kept += [zip_counts(c), zip_counts(t)]
                    sums = sums + pair_t
                n = np.bincount(at, t[owner]).astype(np.int64)
                yield pa.RecordBatch.from_pylist([{"bucket": row["bucket"], "seated": zip_counts(c), "at_tables": zip_counts(t), "pair_tables": zip_counts(sums), "kept": kept,
                                                   "codes": zip_ints(code[n > 0]), "code_n": zip_counts(n[n > 0]), "total": int(c.sum()), "tables": int(t.sum()),
                                                   "messages": k.more(pair_t) if order == 2 and sweep else []}], _STATE)
    return run


def _first(homes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in W.parts(batches, 1):  # a bucket at a time
            for row in b.to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([row["bucket"]], pa.int32()), pa.array([_Bucket(row, homes).first()], pa.list_(_MESSAGE))], names=["bucket", "messages"])
    return run


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in W.parts(batches, 1):
        for row in b.to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array(unzip_ints(row["codes"]).astype(np.int64)), pa.array(unzip_counts(row["code_n"]).astype(np.int64))], names=["code", "n"])


_REPLY = pa.schema([("bucket", pa.int32()), ("home", pa.int32()), ("tables", pa.binary()), ("customers", pa.binary())])


def _home(rows: pa.Table) -> pa.Table:
    """Adds up each context's tables and customers over all buckets and tells each bucket that asked."""
    rows = rows.to_pylist()
    asked = [unzip_longs(r["contexts"]) for r in rows]
    contexts, at = np.unique(np.concatenate(asked), return_inverse=True)
    t, c = (np.bincount(at, np.concatenate([unzip_counts(r[x]) for r in rows]), len(contexts)) for x in ("tables", "customers"))
    parts = np.split(at, np.cumsum([len(x) for x in asked])[:-1])
    return pa.Table.from_pylist([{"bucket": r["bucket"], "home": r["home"], "tables": zip_counts(t[i]), "customers": zip_counts(c[i])} for r, i in zip(rows, parts)], _REPLY)


def _replies(messages: DataFrame, name: str) -> DataFrame:
    return (messages.select("bucket", F.inline("messages")).groupBy("home").applyInArrow(_home, "bucket int, home int, tables binary, customers binary")
            .groupBy("bucket").agg(F.collect_list(F.struct("home", "tables", "customers")).alias(name)))


def _seen(known):
    """The spelling mass of the words of each bucket that have customers, under each kept model."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in W.parts(batches, 1):  # a bucket at a time
            for row in b.to_pylist():
                spelt, c = coded(unzip_pieces(row["words"])), unzip_counts(row["counts"])
                mass = [float(model.coded(*spelt)[c > 0].sum()) for model, _, _ in known.value]
                yield pa.RecordBatch.from_arrays([pa.array(range(len(mass)), pa.int32()), pa.array(mass, pa.float64())], names=["sample", "mass"])
    return run


_FOUND = ("at", "counts", "customers", "rooms", "shares", "times", "tables")


def _score(known, seen: list[float], d: float, homes: int):
    """What each block needs of a bucket's words and pairs, by the places of the block's own: for each kept sweep the words' probabilities in
    the word restaurant and their tables as contexts; the pairs' customers, and their tables summed over the kept sweeps."""
    schema = pa.schema([("block", pa.int64()), *((c, pa.binary()) for c in _FOUND)])

    def score(states: pa.Table, places: pa.Table) -> pa.Table:
        row = states.to_pylist()[0]
        k, spelt, shares = _Bucket(row, homes), coded(unzip_pieces(row["words"])), []
        kept = [unzip_counts(x) for x in row["kept"]] + [k.tables[k.own].astype(W.U)]
        for (model, total, tables), mass, c, t in zip(known.value, seen, kept[::3], kept[1::3]):
            new = (THETA + d * tables) * max(1 - mass, 0) / (THETA + total)
            shares.append(np.where(k.counts > 0, _word(c.astype(float), t.astype(float), model.coded(*spelt), d, total, tables), new))
        shares, rooms = np.array(shares, np.float32).view(np.uint32), np.array(kept[2::3])
        counts, customers = k.counts, k.customers[k.own]
        times, at_tables = (np.concatenate([[0], x.astype(np.int64)]) for x in (k.times, unzip_counts(row["pair_tables"])))  # none for a pair that is not learnt
        del kept, k, spelt

        def rows():
            for i in range(places.num_rows):
                b = places.slice(i, 1).to_pylist()[0]
                word, pair = unzip_steps(b["word_at"]), unzip_steps(b["pair_at"])
                yield {"block": b["block"], "at": b["at"], "counts": zip_counts(counts[word]), "customers": zip_counts(customers[word]), "rooms": zip_counts(rooms[:, word].ravel()),
                       "shares": zip_ints(shares[:, word].ravel()), "times": zip_counts(times[pair]), "tables": zip_counts(at_tables[pair])}

        return pa.Table.from_batches(_gathered(rows(), schema), schema)
    return score


def _documents(schema: pa.Schema, total: int, kinds: int, keep: int, d_pair: float):
    def run(blocks: pa.Table, found: pa.Table) -> pa.Table:
        def of(name, unzip=unzip_counts):
            return np.concatenate([unzip(x) for x in found.column(name).to_pylist()])

        at = of("at", unzip_ints)
        count, customers = np.empty((2, len(at)), np.int64)
        count[at], customers[at] = of("counts"), of("customers")
        share, weight = (np.empty((keep, len(at)), np.float32) for _ in "sw")
        share[:, at] = np.concatenate([unzip_ints(x).view(np.float32).reshape(keep, -1) for x in found.column("shares").to_pylist()], axis=1)
        rooms = np.concatenate([unzip_counts(x).reshape(keep, -1) for x in found.column("rooms").to_pylist()], axis=1)
        weight[:, at] = (THETA + d_pair * rooms) / (THETA + customers[at])  # the share of the word restaurant after each word
        base = np.log10((count + SMOOTH) / (total + SMOOTH * (kinds + 1)))
        out = []
        for docs, places in zip(blocks.column("docs").to_pylist(), blocks.column("places").to_pylist()):
            seq = unzip_ints(places)
            code, pair = distinct(pairs_of(seq, len(at)))
            word, before = np.divmod(code, len(at))
            sizes = np.bincount(word, minlength=len(at))
            own = of("times").astype(np.int64) - d_pair * of("tables").astype(float) / keep
            p = np.empty(len(code))
            p[ragged(np.arange(len(code)), np.cumsum(sizes) - sizes, sizes, at)[0]] = own
            p = (p / (THETA + customers[before])).astype(np.float32).astype(float)  # the pairs' own share of their context
            for s, w in zip(share, weight):
                p += w[before].astype(float) * s[word] / keep
            model = np.log10(np.maximum(p, 1e-300))
            n = np.array([d["n"] for d in docs])
            begin = np.cumsum(n) - n
            sums = [np.add.reduceat(x, begin) for x in (base[seq], model[pair], (count > 0).astype(np.int64)[seq])]
            out.append(pa.RecordBatch.from_arrays(
                [pa.array([d["doc_id"] for d in docs], schema.field(0).type), pa.array([not d["learns"] for d in docs]), pa.array(n), pa.array(sums[2]),
                 pa.array(np.full(len(n), total)), pa.array(sums[0]), pa.array(sums[1])], schema=schema))
        return pa.Table.from_batches(out, schema)
    return run


#: Characters of text per block and, about, per bucket and home: what a task holds at a time, whatever the corpus.
BLOCK, PER_BUCKET, PER_HOME = 8 << 20, 4 << 20, 32 << 20


def scored(docs: DataFrame, learns: Column, burn: int = BURN, keep: int = KEEP, order: int = 1) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs`` (doc_id, text).

    Only texts marked by ``learns`` are learnt from; the others are held out. ``order`` 2 has a restaurant for each word before,
    ``order`` 1 the word restaurant alone. Null and empty texts are one token, the end. Without
    training texts every token is the unknown word, with probability 1. Repeated rows and null ids are rows like
    any other; other columns are not read. ``score`` sums log10 probabilities per token, so ``10 ** (-score / n_tokens)`` is the perplexity.
    """
    spark = docs.sparkSession
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chars = docs.agg(F.sum(F.length(F.col("text").cast("string")))).first()[0] or 0
    homes = max(1, min(most, -(-chars // PER_HOME)))  # every bucket writes to every home: a small corpus needs few of both
    buckets = max(1, -(-chars // PER_BUCKET), min(most, -(-4 * chars // PER_BUCKET)))
    blocks = packed(docs, tokens, learns, BLOCK, dealt=False)
    bucketed = with_pairs(blocks, buckets, _hash).repartition("bucket").sortWithinPartitions("bucket")
    dealt = kept_by(bucketed.mapInArrow(_vocabulary(order), VOCABULARY), "bucket", "vocabulary")
    vocabulary = dealt.filter("block IS NULL").drop("block", "at", "word_at", "pair_at")
    total, kinds, once, twice, pairs_once, pairs_twice = (x or 0 for x in vocabulary.agg(*[F.sum(c) for c in ("n", "v", "once", "twice", "pairs_once", "pairs_twice")]).first())
    d, d_pair = discount(once, twice), discount(pairs_once, pairs_twice)
    still = vocabulary.drop("n", "v", "once", "twice", "pairs_once", "pairs_twice")
    if order == 2:
        asked = still.mapInArrow(_first(homes), "bucket int, messages array<struct<home:int,contexts:binary,tables:binary,customers:binary>>")
        still = still.join(kept_by(_replies(asked, "first"), "bucket", "contexts").hint("merge"), "bucket")
    model, seated, tables, kept, rows = None, 0, 0, [], still
    for sweep in range(burn + keep + 1):
        shared = spark.sparkContext.broadcast((model, seated, tables))
        state = kept_by(rows.mapInArrow(_sweep(shared, d, d_pair, sweep, burn, order, homes), STATE), "bucket", "seating")
        shared.destroy()
        seated, tables = (x or 0 for x in state.agg(F.sum("total"), F.sum("tables")).first())
        sums = (state.select("codes", "code_n").mapInArrow(_codes, "code bigint, n bigint")
                .groupBy("code").agg(F.sum("n").alias("n")).toArrow())  # 64**3 * 257 rows at most, whatever the corpus
        code, n = sums.column("code").to_numpy(), sums.column("n").to_numpy()
        at = np.argsort(code)
        model = Spelling(code[at], n[at], model, sweep)
        rows = (still.join(state.select("bucket", "seated", "at_tables", "pair_tables", "kept").hint("merge"), "bucket")
                .join(_replies(state, "replies").hint("merge"), "bucket", "left"))
        if sweep > burn:
            kept.append((model, seated, tables))
    known = spark.sparkContext.broadcast(kept)
    masses = vocabulary.select("words", "counts").mapInArrow(_seen(known), "sample int, mass double").groupBy("sample").agg(F.sum("mass").alias("mass")).collect()
    masses = dict(map(tuple, masses))
    places = dealt.filter("block IS NOT NULL").select(F.col("bucket").alias("part"), "block", "at", "word_at", "pair_at")
    found = (rows.groupBy("bucket").cogroup(places.groupBy("part"))  # both lie by bucket already
             .applyInArrow(_score(known, [masses.get(i, 0.0) for i in range(len(kept))], d, homes), "block bigint, " + ", ".join(f"{c} binary" for c in _FOUND)))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = pa.schema([("doc_id", arrow_type(kind)), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
    return (blocks.select("block", "docs", "places").groupBy("block").cogroup(found.groupBy("block"))
            .applyInArrow(_documents(schema, total, kinds, keep, d_pair), f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"))


def op10_pitman_yor(spark, sf_dir) -> DataFrame:
    return scored(spark.read.parquet(f"{sf_dir}/documents.parquet"), F.coalesce(remainder(10) != 0, F.lit(True)), order=2)

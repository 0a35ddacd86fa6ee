"""Quality rules by n-gram perplexity: a modified Kneser-Ney model of word pairs with perplexity bands by language.

Every language has a model of its own, counted over all its texts in Spark. Words are lower-cased (A-Z) and stand as 32-bit hashes,
so a pair is one 64-bit number; of v different words about ``v / 2**32`` share their number with another. A text is its words and
one end, each seen after the word before it; the first is seen after the start.

Texts are packed into blocks of one language (``SIZE`` bytes), which keep positions into their distinct words. A block's distinct pairs,
as sorted arrays dealt into buckets, meet in their bucket, are counted once for the whole corpus and go back by position. A pair that
makes up a third of all text still occurs once per block. Pairs are dealt by their first word, which keeps the arrays and the sums
short, and the followers of a word over ``1 + buckets // SPREAD`` buckets, so a frequent word does not fill one. The buckets also add
up, for each word, what follows it and how many words it follows; these sums meet by word in a second round. The number of buckets
follows the size of the texts, so a bucket's size does not.

A text must not explain itself: its probability comes from the counts without its own words and those of its exact copies (counts,
totals, continuation counts and the weights of the lower order are reduced by what is only there because of them; the discounts are
the corpus'). What is left is a Kneser-Ney model again.

Nor must its near copies explain it; they are for another operator to judge. Their number is how many texts hold half of the
``SKETCH`` least hashes of a text's runs of ``SPAN`` words, twice that to be safe, but no more than three quarters of its pairs occur elsewhere. A text that
has some is scored a second time, ``alone``, as if it had as many more copies.

The spread of log perplexity shrinks with the length of a text, so a band belongs to a language and a class of length (powers of
two). It reaches from the median of the class, of the log perplexities alone, ``WIDE`` times the distance to the quartile on either
side, taken as ``LEAST`` at least; each different text counts once. Classes of few texts take median and quartiles in part from the
whole language, weighted as ``FEW`` texts. Texts outside are rejected: above, what does not read like the language; below, text whose
every word follows from the one before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthgrid.llm import words as W
from monthgrid.llm.blocks import arrow_type, kept_by, unzip_ints, unzip_longs, zip_ints, zip_longs
from monthgrid.session import stage

#: Bytes of text in a block, and of all texts for each bucket of pairs.
SIZE, BUCKET, SPREAD = 12 << 20, 32 << 20, 16
START, END = 0, 1
WIDE, LEAST, FEW = 3.5, 0.2, 20
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, REPEAT_PERCENT, SPAN = 10, 20, 5
SKETCH = 8
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_WORD = np.uint64(0xFFFFFFFF)
_HALF = np.uint64(32)


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words of each text and its end, how many). A text without words has none."""
    words = W.split(texts, lower=True)
    n = np.diff(words.first)
    size = np.where(n > 0, n + 1, 0)
    begin = np.cumsum(size) - size
    seq = np.full(int(size.sum()), END, np.uint32)
    seq[np.arange(len(words.hash)) + np.repeat(begin - words.first[:-1], n)] = np.maximum(words.hash >> _HALF, W.U(END + 1))
    return seq, size


def pairs(seq: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Code of each token with the one before it: the first of a text comes after the start."""
    before = np.roll(seq, 1).astype(np.uint64)
    before[(np.cumsum(size) - size)[size > 0]] = START
    return before << _HALF | seq.astype(np.uint64)


def base_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    words = W.split(texts)
    n_words = np.diff(words.first)
    size = np.array([len(t) for t in texts], np.int64)
    begin = np.concatenate([[0], np.cumsum(size + 1)])

    def per_text(flag):
        total = np.concatenate([[0], np.cumsum(flag)])
        return total[begin[1:] - 1] - total[begin[:-1]]

    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    dup = []
    for t in texts:
        lines = [x for x in t.split(b"\n") if x.strip(bytes(W.SPACES))]
        dup.append(len(lines) - len(set(lines)))
    owner = words.owner()
    grams = W.ngrams(words.hash, SPAN)
    repeated = np.zeros(len(words.hash), np.int64)
    if len(grams):
        inside = W.within(words, SPAN)
        at = np.flatnonzero(inside)
        _, which, n = np.unique(W.mix(grams[at] ^ W.mix(owner[at].astype(W.U))), return_inverse=True, return_counts=True)
        at = at[n[which] > 1]
        change = np.zeros(len(words.hash) + 1, np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, at + SPAN, -1)
        repeated = (np.cumsum(change)[:-1] > 0).astype(np.int64)
    return {"n_words": n_words, "word_chars": per_text(W.NOT_SPACE[words.data] & ((words.data & 0xC0) != 0x80)), "n_symbols": per_text(symbol[words.data]),
            "n_dup_lines": np.array(dup, np.int64), "n_repeat_words": np.bincount(owner, repeated, minlength=len(texts)).astype(np.int64)}


def sketches(texts: list[bytes]) -> list[list[int]]:
    """The least hashes of each text's runs of words, their low halves; a text of fewer words than a run has none."""
    words = W.split(texts, lower=True)
    grams, first = W.ngrams(words.hash, SPAN), words.first
    out = []
    for i, j in zip(first[:-1].tolist(), first[1:].tolist()):
        own = grams[i:max(i, j - SPAN + 1)]
        some = 8 * SKETCH  # enough for most texts, whatever repeats; else all
        least = np.unique(np.partition(own, some)[:some] if len(own) > some else own)
        out.append((least if len(least) >= SKETCH else np.unique(own))[:SKETCH].astype(np.uint32).view(np.int32).tolist())
    return out


def _ranges(bucket: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order by bucket (sorted values stay sorted inside), and (bucket, from, to) of those that have any."""
    order = np.argsort(bucket, kind="stable")
    some, first = np.unique(bucket[order], return_index=True)
    return order, list(zip(some.tolist(), first.tolist(), [*first[1:].tolist(), len(bucket)]))


def _deal_words(words: np.ndarray, buckets: int):
    return _ranges((W.mix(words.astype(np.uint64)) % W.U(buckets)).astype(np.int32))


def _deal_pairs(codes: np.ndarray, buckets: int):
    apart = W.mix(codes & _WORD) % W.U(1 + buckets // SPREAD)
    return _ranges(((W.mix(codes >> _HALF) % W.U(buckets) + apart) % W.U(buckets)).astype(np.int32))


def _zip_words(words: np.ndarray) -> bytes:
    """Words in runs of sorted ones, by steps; the step from a run to the next wraps around."""
    return zip_ints(np.diff(words, prepend=np.uint32(0)))


def _unzip_words(data: bytes) -> np.ndarray:
    return np.cumsum(unzip_ints(data), dtype=np.uint32)


def _zip_pairs(codes: np.ndarray) -> list[bytes]:
    """Sorted pairs: the different first words and how many pairs each has, and the second words as steps in a sorted list of their own.

    A word's hash is 32 random bits, which no compression makes shorter; a step is few.
    """
    before, after = codes >> _HALF, (codes & _WORD).astype(np.uint32)
    firsts = np.flatnonzero(np.diff(before, prepend=before[:1] + W.U(1)))
    seconds, at = np.unique(after, return_inverse=True)
    steps = np.diff(at, prepend=0)
    steps[firsts] = at[firsts]
    own = before[firsts].astype(np.uint32)
    return [zip_ints(x) for x in (np.diff(own, prepend=np.uint32(0)), np.diff(firsts, append=len(codes)), np.diff(seconds, prepend=np.uint32(0)), steps)]


def _unzip_pairs(data: list[bytes]) -> np.ndarray:
    own, sizes, seconds, steps = map(unzip_ints, data)
    total = np.cumsum(steps, dtype=np.int64)
    firsts = np.cumsum(sizes, dtype=np.int64) - sizes
    at = total - np.repeat(total[firsts] - steps[firsts], sizes)
    return np.repeat(np.cumsum(own, dtype=np.uint64), sizes) << _HALF | np.cumsum(seconds, dtype=np.uint64)[at]


def _pack(size: int, ids: pa.DataType):
    doc = pa.struct([("doc_id", ids), ("digest", pa.int64()), ("n_tokens", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("sketch", pa.list_(pa.int32()))])
    schema = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("docs", pa.list_(doc)), ("places", pa.binary()), ("words", pa.binary())])

    def close(number, lang, docs, seqs):
        words, at, times = np.unique(np.concatenate(seqs), return_inverse=True, return_counts=True)
        order = np.argsort(-np.log2(times).astype(np.int64), kind="stable")  # frequent words get small numbers; about equally frequent ones stay sorted
        rank = np.empty(len(words), np.uint32)
        rank[order] = np.arange(len(words), dtype=np.uint32)
        return pa.RecordBatch.from_pylist([{"block": number, "lang": lang, "docs": docs, "places": zip_ints(rank[at]), "words": _zip_words(words[order])}], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: dict = {}  # lang: [bytes, rows, tokens]
        for b in W.parts(batches):
            texts = W.as_bytes(b.column("text"))
            keys, digests, langs = (b.column(c).to_pylist() for c in ("doc_id", "digest", "lang"))
            for i, j in W.batches(texts):
                base, sketch = base_counts(texts[i:j]), sketches(texts[i:j])
                seq, n = tokens(texts[i:j])
                end = np.cumsum(n)
                for k in range(i, j):
                    block = held.setdefault(langs[k], [0, [], []])
                    block[0] += len(texts[k]) + 1
                    block[1].append({"doc_id": keys[k], "digest": digests[k], "n_tokens": int(n[k - i])} | {c: int(base[c][k - i]) for c in COUNTS} | {"sketch": sketch[k - i]})
                    block[2].append(seq[end[k - i] - n[k - i]:end[k - i]].copy())
                while held and sum(x[0] for x in held.values()) > size:
                    lang = max(held, key=lambda x: held[x][0])
                    yield close(number, lang, *held.pop(lang)[1:])
                    number += 1
        for lang, (_, docs, seqs) in held.items():
            yield close(number, lang, docs, seqs)
            number += 1
        W.give_back()
    return run


def blocks(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(block, lang, docs, places, words) of all texts, kept in the shared folder by block."""
    text = F.col("text").cast("string")
    kind = docs.schema["doc_id"].dataType.simpleString()
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    return kept_by(docs.select("doc_id", lang.alias("lang"), F.xxhash64(text).alias("digest"), text.alias("text")).mapInArrow(
        _pack(size, arrow_type(kind)),
        f"block bigint, lang string, docs array<struct<doc_id:{kind},digest:bigint,n_tokens:bigint,{','.join(c + ':bigint' for c in COUNTS)},sketch:array<int>>>, "
        "places binary, words binary"), "block", "perplexity_blocks")


def _share_pairs(buckets: int):
    """(lang, bucket, block, codes, times) of a block's distinct pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in W.parts(batches, 1):
            block, lang, places, words, n = (c[0].as_py() for c in b.columns)
            codes, times = np.unique(pairs(_unzip_words(words)[unzip_ints(places)], np.array(n, np.int64)), return_counts=True)
            order, ranges = _deal_pairs(codes, buckets)
            codes, times = codes[order], times[order]
            for k, i, j in ranges:
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang], pa.string()), "bucket": pa.array([k], pa.int32()), "block": [block],
                                                  "codes": pa.array([_zip_pairs(codes[i:j])], pa.list_(pa.binary())), "times": [zip_ints(times[i:j])]})
        W.give_back()
    return run


def _block_words(words: bytes) -> np.ndarray:
    """A block's words and the start, sorted."""
    return np.sort(np.append(_unzip_words(words), np.uint32(START)))


def _share_words(buckets: int):
    """(lang, bucket, block, data) of a block's distinct words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in W.parts(batches, 1):
            block, lang, words = (c[0].as_py() for c in b.columns)
            words = _block_words(words)
            if len(words) > 1:
                order, ranges = _deal_words(words, buckets)
                words = words[order]
                for k, i, j in ranges:
                    yield pa.RecordBatch.from_pydict({"lang": pa.array([lang], pa.string()), "bucket": pa.array([k], pa.int32()), "block": [block],
                                                      "data": pa.array([[zip_ints(words[i:j])]], pa.list_(pa.binary()))})
    return run


_ANSWER = "lang string, kind string, block bigint, bucket int, data array<binary>, sums array<bigint>"
_ANSWER_ARROW = pa.schema([("lang", pa.string()), ("kind", pa.string()), ("block", pa.int64()), ("bucket", pa.int32()),
                           ("data", pa.list_(pa.binary())), ("sums", pa.list_(pa.int64()))])


def _answers(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, _ANSWER_ARROW)


def _of_counts(c: np.ndarray) -> list[int]:
    """How many of the counts are 1, 2, 3, 4, how many there are above 0, and their sum."""
    return [*np.bincount(np.minimum(c, 5), minlength=5)[1:5].tolist(), int((c > 0).sum()), int(c.sum())]


def _count_pairs(buckets: int):
    def run(rows: pa.Table) -> pa.Table:
        lang, bucket = rows["lang"][0].as_py(), rows["bucket"][0].as_py()
        asked = rows["block"].to_pylist()
        codes = [_unzip_pairs(x.as_py()) for x in rows["codes"]]
        times = np.concatenate([unzip_ints(x.as_py()) for x in rows["times"]])
        ends = np.cumsum([len(x) for x in codes])
        pair, at = np.unique(np.concatenate(codes), return_inverse=True)
        c = np.bincount(at, times).astype(np.int64)
        out = [{"lang": lang, "kind": "pairs", "block": b, "bucket": bucket, "data": [zip_longs(c[at[e - len(x):e]])]} for b, x, e in zip(asked, codes, ends)]
        before, first = np.unique(pair >> _HALF, return_index=True)
        after, continues = np.unique(pair & _WORD, return_counts=True)
        words = np.union1d(before, after)
        table = np.zeros((5, len(words)), np.int64)
        here = np.searchsorted(words, before)
        for row, x in enumerate([c, c == 1, c == 2, c > 2]):
            table[row, here] = np.add.reduceat(x.astype(np.int64), first)
        table[4, np.searchsorted(words, after)] = continues
        order, ranges = _deal_words(words, buckets)
        words, table = words[order], table[:, order]
        out += [{"lang": lang, "kind": "words", "bucket": k, "data": [zip_ints(words[i:j]), *(zip_longs(x[i:j]) for x in table)]} for k, i, j in ranges]
        out.append({"lang": lang, "kind": "pair sums", "sums": _of_counts(c)})
        return _answers(out)
    return run


def _count_words(rows: pa.Table) -> pa.Table:
    lang, bucket = rows["lang"][0].as_py(), rows["bucket"][0].as_py()
    asked, data = rows["block"].to_pylist(), rows["data"].to_pylist()
    parts = [d for b, d in zip(asked, data) if b is None]
    words, at = np.unique(np.concatenate([unzip_ints(d[0]) for d in parts]), return_inverse=True)
    table = [np.bincount(at, np.concatenate([unzip_longs(d[k]) for d in parts])).astype(np.int64) for k in range(1, 6)]
    out = []
    for b, d in zip(asked, data):
        if b is not None:
            here = np.searchsorted(words, unzip_ints(d[0]))
            out.append({"lang": lang, "kind": "words", "block": b, "bucket": bucket, "data": [zip_longs(x[here]) for x in table]})
    out.append({"lang": lang, "kind": "word sums", "sums": _of_counts(table[4])})
    return _answers(out)


def discounts(of_counts) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2 and 3 or more, from how many counts are 1 to 4; between 0.1 and just under the count."""
    n = [0.0, *map(float, of_counts[:4])]
    y = n[1] / (n[1] + 2 * n[2]) if n[1] + n[2] else 0.5
    d = [0.0] + [k - (k + 1) * y * n[k + 1] / n[k] if n[k] else k / 2 for k in (1, 2, 3)]
    return np.clip(d, [0, 0.1, 0.1, 0.1], [0, 0.95, 1.95, 2.95])


def _per(key: np.ndarray, *sums: np.ndarray):
    """The distinct keys, where each row's key is among them, and the sums of the columns by key."""
    some, at = np.unique(key, return_inverse=True)
    return some, at, *(np.bincount(at, x, len(some)) for x in sums)


def shared_by_all(text: np.ndarray, rest: np.ndarray, n: int) -> np.ndarray:
    """Of each text the count that three quarters of its different pairs reach elsewhere; ``rest`` counts each pair of a text, sorted by text."""
    size = np.bincount(text, minlength=n)
    some = size > 0
    at = (np.cumsum(size) - size + size // 4)[some]
    out = np.zeros(n, np.int64)
    out[some] = rest[np.lexsort((rest, text))[at]]
    return out


def log_probabilities(codes, count, place, n_tokens, copies, alike, words, table, pair_sums, word_sums) -> tuple[np.ndarray, np.ndarray]:
    """Natural log probability of each text of a block, from all counts without the text and its ``copies`` (itself included); and
    that without its near copies either, of which ``alike`` texts, copies included, may be.

    ``codes`` are the block's pairs and ``count`` their counts, ``place`` the pair of each token, ``n_tokens`` how many a text has;
    ``words`` are sorted, with the columns of ``table``: tokens that follow, how many pairs begin here once, twice, more often, and how many end here.
    """
    d2, d1 = discounts(pair_sums), discounts(word_sums)
    total, once, twice, often, ends = table
    left = d2[1] * once + d2[2] * twice + d2[3] * often
    kinds, all_ends = word_sums[4], word_sums[5]
    spread = d1[1] * word_sums[0] + d1[2] * word_sums[1] + d1[3] * (kinds - word_sums[0] - word_sums[1])
    n, w = len(n_tokens), len(words)
    owner = np.repeat(np.arange(n), n_tokens)
    key, own = np.unique(owner * max(1, len(codes)) + place, return_counts=True)  # the different pairs of each text
    text, pair = np.divmod(key, max(1, len(codes)))
    before, after = np.searchsorted(words, codes >> _HALF)[pair], np.searchsorted(words, codes & _WORD)[pair]
    near = np.clip(2 * (alike - copies), 0, shared_by_all(text, count[pair] - own * copies[text], n))

    def of(text, pair, before, after, own, copies):
        c = count[pair]
        taken = np.minimum(c, own * copies[text])
        return _reduced(c, taken, text, before, after, own, n, w, d1, d2, total, left, ends, kinds, all_ends, spread)
    plain = of(text, pair, before, after, own, copies)
    twin = near[text] > 0
    return plain, np.where(near > 0, of(*(x[twin] for x in (text, pair, before, after, own)), copies + near), plain) if twin.any() else plain


def _reduced(c, taken, text, before, after, own, n, w, d1, d2, total, left, ends, kinds, all_ends, spread) -> np.ndarray:
    """Log probability of each of ``n`` texts by its different pairs, which occur ``own`` times in it, once ``taken`` of their ``c`` occurrences are gone."""
    rest = c - taken
    cut = d2[np.minimum(rest, 3)]
    gone = (rest == 0).astype(np.int64)
    _, at, own_total, own_left = _per(text * w + before, taken, d2[np.minimum(c, 3)] - cut)
    follow = total[before] - own_total[at]
    weight = left[before] - own_left[at]
    word_key, word_at, own_ends = _per(text * w + after, gone)
    word_text, word = np.divmod(word_key, max(1, w))
    e = ends[word] - own_ends.astype(np.int64)
    word_cut = d1[np.minimum(e, 3)]
    all_e = (all_ends - np.bincount(text, gone, n))[word_text]
    own_spread = np.bincount(word_text, d1[np.minimum(ends[word], 3)] - word_cut, n)[word_text]
    low = np.where(all_e > 0, (e - word_cut + (spread - own_spread) / max(1, kinds)) / np.maximum(all_e, 1), 1 / max(1, kinds))[word_at]
    p = np.where(follow > 0, (rest - cut + weight * low) / np.maximum(follow, 1), low)
    return np.bincount(text, own * np.log(p), n)


def _score(ids: pa.DataType, buckets: int):
    schema = pa.schema([("doc_id", ids), ("lang", pa.string()), ("digest", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("n_tokens", pa.int64()), ("log_perplexity", pa.float64()), ("alone", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in W.parts(batches, 1):
            row = b.to_pylist()[0]
            docs = row["docs"]
            n = np.array([d["n_tokens"] for d in docs], np.int64)
            loss, alone = np.zeros((2, len(docs)))
            copies = np.ones(len(docs), np.int64)
            for x in row["copies"] or []:
                copies[x["places"]] = x["n"]
            alike = copies.copy()
            for x in row["alike"] or []:
                alike[x["place"]] = x["n"]
            if n.any():
                codes, place = np.unique(pairs(_unzip_words(row["words"])[unzip_ints(row["places"])], n), return_inverse=True)
                words = _block_words(row["words"])
                answer = {(x["kind"], x["bucket"]): x["data"] for x in row["answers"]}
                order, ranges = _deal_pairs(codes, buckets)
                count = np.empty(len(codes), np.int64)
                count[order] = np.concatenate([unzip_longs(answer["pairs", k][0]) for k, _, _ in ranges])
                order, ranges = _deal_words(words, buckets)
                table = np.empty((5, len(words)), np.int64)
                for row_of in range(5):
                    table[row_of, order] = np.concatenate([unzip_longs(answer["words", k][row_of]) for k, _, _ in ranges])
                loss, alone = (-x for x in log_probabilities(codes, count, place, n, copies, alike, words.astype(np.uint64), table, row["pair_sums"], row["word_sums"]))
            levels = [pa.array(np.divide(x, n, out=np.zeros(len(docs)), where=n > 0), mask=n == 0) for x in (loss, alone)]
            yield pa.RecordBatch.from_arrays([pa.array([d["doc_id"] for d in docs], ids), pa.array([row["lang"]] * len(docs), pa.string()), pa.array([d["digest"] for d in docs], pa.int64()),
                                              *(pa.array([d[c] for d in docs], pa.int64()) for c in COUNTS), pa.array(n), *levels], schema=schema)
        W.give_back()
    return run


def _sums(answers: DataFrame, kind: str, name: str) -> DataFrame:
    return (answers.filter(F.col("kind") == kind).groupBy("lang").agg(F.array(*(F.sum(F.col("sums")[i]) for i in range(6))).alias(name))
            .withColumnRenamed("lang", f"{name}_lang"))


def _copies(packed: DataFrame) -> DataFrame:
    """(of, copies): for each block the places of texts that occur several times in their language, and how often.

    A text is brought together once per block, so one that makes up a third of all rows is as many rows as there are blocks.
    """
    here = (packed.select("block", "lang", F.posexplode("docs.digest").alias("place", "digest"))
            .groupBy("lang", "digest", "block").agg(F.collect_list("place").alias("places")))
    here = stage(here, "text-places")
    n = here.groupBy("lang", "digest").agg(F.sum(F.size("places")).alias("n")).filter("n > 1").select(F.col("lang").alias("in"), F.col("digest").alias("same"), "n")
    return (here.join(n, (here["digest"] == n["same"]) & here["lang"].eqNullSafe(n["in"]))
            .groupBy(F.col("block").alias("of")).agg(F.collect_list(F.struct("places", "n")).alias("copies")))


def _alike(packed: DataFrame) -> DataFrame:
    """(of, alike): for each block the places of texts that others resemble, and how many texts, itself included, hold half of its sketch.

    As for copies, a run of words that is in a third of all texts is as many rows as there are blocks.
    """
    here = (packed.select("block", "lang", F.posexplode("docs.sketch").alias("place", "sketch"))
            .select("block", "lang", F.struct("place", F.size("sketch").alias("of")).alias("text"), F.explode("sketch").alias("run"))
            .groupBy("lang", "run", "block").agg(F.collect_list("text").alias("texts")))
    here = stage(here, "text-runs")
    n = here.groupBy("lang", "run").agg(F.sum(F.size("texts")).alias("n")).filter("n > 1").select(F.col("lang").alias("in"), F.col("run").alias("same"), "n")
    found = here.join(n, (here["run"] == n["same"]) & here["lang"].eqNullSafe(n["in"])).select("block", "n", F.inline("texts"))
    return (found.groupBy("block", "place").agg(F.max("of").alias("of"), F.sort_array(F.collect_list("n"), False).alias("n"))
            .select("block", "place", F.try_element_at("n", F.expr("cast((of + 1) div 2 AS int)")).alias("n")).filter("n IS NOT NULL")
            .groupBy(F.col("block").alias("of")).agg(F.collect_list(F.struct("place", "n")).alias("alike")))


def scored(docs: DataFrame, size: int = SIZE, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, lang, digest, the base counts, n_tokens, log_perplexity, alone) of every row; both are null for a text without words.

    ``log_perplexity`` is that without the text and its exact copies, ``alone`` that without near copies either.
    """
    total = docs.select(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    buckets = 1 + total // bucket
    packed = blocks(docs, size)
    shares = packed.select("block", "lang", "places", "words", F.col("docs.n_tokens").alias("n")).mapInArrow(
        _share_pairs(buckets), "lang string, bucket int, block bigint, codes array<binary>, times binary")
    known = stage(shares.groupBy("lang", "bucket").applyInArrow(_count_pairs(buckets), _ANSWER), "pair-counts")
    sums = known.filter("kind = 'words'").select("lang", "bucket", F.lit(None).cast("bigint").alias("block"), "data")
    asked = packed.select("block", "lang", "words").mapInArrow(_share_words(buckets), "lang string, bucket int, block bigint, data array<binary>")
    by_word = stage(sums.unionByName(asked).groupBy("lang", "bucket").applyInArrow(_count_words, _ANSWER), "word-counts")
    answers = (known.filter("kind = 'pairs'").unionByName(by_word.filter("kind = 'words'"))
               .groupBy(F.col("block").alias("to")).agg(F.collect_list(F.struct("kind", "bucket", "data")).alias("answers")))
    copies, alike = _copies(packed), _alike(packed)
    whole = packed.join(answers, packed["block"] == answers["to"], "left").join(copies, packed["block"] == copies["of"], "left").join(alike, packed["block"] == alike["of"], "left")
    for rows, kind, name in ((known, "pair sums", "pair_sums"), (by_word, "word sums", "word_sums")):
        of = _sums(rows, kind, name)
        whole = whole.join(of, packed["lang"].eqNullSafe(of[f"{name}_lang"]), "left")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return (whole.select("lang", "docs", "places", "words", "answers", "copies", "alike", "pair_sums", "word_sums")
            .mapInArrow(_score(arrow_type(kind), buckets), f"doc_id {kind}, lang string, digest bigint, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", n_tokens bigint, log_perplexity double, alone double"))


def bands(rows: DataFrame, wide: float = WIDE) -> DataFrame:
    """(band_lang, band_length, lowest, highest): the log perplexities alone that texts of a language and a class of length may have."""
    texts = rows.filter("alone IS NOT NULL").groupBy("lang", "length", "digest").agg(F.max("alone").alias("alone"))

    def quartiles(*by):
        q = F.percentile_approx("alone", [0.25, 0.5, 0.75], 10000)
        return texts.groupBy(*by).agg(q.alias("q"), F.count("*").alias("n"))
    whole = quartiles("lang").select(F.col("lang").alias("whole_lang"), F.col("q").alias("whole"))
    parts = quartiles("lang", "length")
    here = F.col("n") / (F.col("n") + FEW)
    low, middle, high = (here * F.col("q")[i] + (1 - here) * F.col("whole")[i] for i in range(3))
    return parts.join(whole, F.col("lang").eqNullSafe(F.col("whole_lang"))).select(
        F.col("lang").alias("band_lang"), F.col("length").alias("band_length"),
        (middle - wide * F.greatest(middle - low, F.lit(LEAST))).alias("lowest"), (middle + wide * F.greatest(high - middle, F.lit(LEAST))).alias("highest"))


def judged(docs: DataFrame, wide: float = WIDE) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, log_perplexity of every row of ``docs`` (doc_id, text, lang).

    Null and empty texts have no words and fail the base rules. A null lang is a language of its own. Repeated rows and null ids
    are rows like any other; other columns are not read.
    """
    rows = stage(scored(docs), "perplexities").withColumn("length", F.floor(F.log2(F.col("n_tokens"))))
    band = bands(rows, wide)
    inside = F.col("alone").between(F.col("lowest"), F.col("highest"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return (rows.join(band, F.col("lang").eqNullSafe(F.col("band_lang")) & (F.col("length") == F.col("band_length")), "left")
            .select("doc_id", *COUNTS, failed.alias("base_failed"), (~failed & F.coalesce(inside, F.lit(False))).alias("kept"), "log_perplexity"))


def op4_perplexity_bands(spark, sf_dir) -> DataFrame:
    return judged(spark.read.parquet(f"{sf_dir}/documents.parquet"))

"""Phrase collocations by counting quotient filters over packed word-id n-grams.

Words are counted per language. Those found often enough get a number, and a phrase of n words is their numbers side by side, in as
few 64-bit limbs as hold them. The first limb, mixed with a hash of the others, goes through a permutation of its own number of
bits, so that codes spread evenly and can be restored. Its top bits name a shard; the next are the *quotient*; what is
left, and the other limbs, is the *remainder*, kept in full. A filter (``zip_codes``) stores sorted distinct codes as the number of
codes of each quotient in unary, the remainders and the counts: lossless, and no larger for a phrase that makes up a third of the
text. Filters of a shard merge like sorted lists, counts added.

A phrase can only be frequent if the phrases without its first and its last word are. So lengths are counted one after the other: each
block of text sends one filter per shard with the phrases that can still be frequent, the shard merges the filters of all blocks and
answers each block with a bit per code, and the block marks the places where a frequent phrase begins. Frequent words become
numbers the same way (``blocks``). Nothing is dropped: what is pruned cannot reach the least count.

A task holds one block, or the filters of one shard; the number of shards grows with the text. A hot word or phrase is one entry
per block. Parts of a frequent phrase are frequent, so all that scores need is in the merged tables.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthgrid.llm.blocks import SIZE, by_bucket, kept_by, packed, unzip_ints, unzip_longs, unzip_pieces, zip_ints, zip_longs
from monthgrid.llm.words import mix
from monthgrid.session import stage

U = np.uint64
LONGEST, LEAST, KEEP = 5, 100, 2000
#: Characters of text per shard, about.
PER_SHARD = 16 << 20
UNKNOWN_LANG = "und"
BREAK = "\n"
_TOKEN = re.compile(r"[^ \t.,;:!?\n-\r]+|[.,;:!?\n-\r]+")
_ENDS = frozenset(".,;:!?\n\x0b\x0c\r")
_TIMES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_LEVEL = 3


def find(text: str) -> list[str]:
    """Words of a text ``<length of lang>:<lang><body>``, each with its language in front, and a break after each piece."""
    size, _, rest = text.partition(":")
    lang, body = rest[:int(size)] + "\t", rest[int(size):]
    out = [BREAK if t[0] in _ENDS else lang + t for t in _TOKEN.findall(body)]
    out.append(BREAK)
    return out


# Packed codes -----------------------------------------------------------------------------------------------------------------

def limb_bits(n: int, bits: int) -> list[int]:
    """Bits of each limb of a phrase of ``n`` words with numbers of ``bits`` bits."""
    per = max(1, 64 // bits)
    return [bits * min(per, n - i) for i in range(0, n, per)]


def pack(words: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """Limbs of many phrases; ``words`` has the numbers of the first words, of the second words, and so on."""
    per, out = max(1, 64 // bits), []
    for i in range(0, len(words), per):
        limb = np.zeros(len(words[0]), U)
        for w in words[i:i + per]:
            limb = (limb << U(bits)) | w.astype(U) if bits < 64 else w.astype(U)
        out.append(limb)
    return out


def unpack(limbs: list[np.ndarray], n: int, bits: int) -> np.ndarray:
    """The word numbers, a row per phrase."""
    out = []
    for limb, size in zip(limbs, limb_bits(n, bits)):
        out += [(limb >> U(shift)) & U((1 << bits) - 1) for shift in range(size - bits, -1, -bits)]
    return np.stack(out, axis=1)


def _permute(x: np.ndarray, bits: int, back: bool = False) -> np.ndarray:
    """A permutation of the numbers of ``bits`` bits: shifts by half, which undo themselves, and odd factors."""
    half, mask = U((bits + 1) // 2), U((1 << bits) - 1)
    for k in (_TIMES[::-1] if back else _TIMES):
        x = x ^ (x >> half)
        x = x * U(pow(k, -1, 1 << bits) if back else k & ((1 << bits) - 1)) & mask
    return x ^ (x >> half)


def _rest_hash(limbs: list[np.ndarray], bits: int) -> np.ndarray:
    h = np.zeros(len(limbs[0]), U)
    for k in limbs[1:]:
        h = mix(h + k + U(1))
    return h >> U(64 - bits)


def scatter(limbs: list[np.ndarray], sizes: list[int]) -> list[np.ndarray]:
    """The first limb permuted, after adding a hash of the others; ``gather`` restores it."""
    first = limbs[0] if len(limbs) == 1 else limbs[0] + _rest_hash(limbs, sizes[0]) & U((1 << sizes[0]) - 1)
    return [_permute(first, sizes[0]), *limbs[1:]]


def gather(limbs: list[np.ndarray], sizes: list[int]) -> list[np.ndarray]:
    first = _permute(limbs[0], sizes[0], back=True)
    return [first if len(limbs) == 1 else first - _rest_hash(limbs, sizes[0]) & U((1 << sizes[0]) - 1), *limbs[1:]]


def _order(limbs: list[np.ndarray]) -> np.ndarray:
    return np.argsort(limbs[0], kind="stable") if len(limbs) == 1 else np.lexsort(limbs[::-1])


def distinct(limbs: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted distinct codes, and the place among them of every given code."""
    order = _order(limbs)
    limbs = [k[order] for k in limbs]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in limbs:
        new[1:] |= k[1:] != k[:-1]
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    return [k[new] for k in limbs], place


# Filters ----------------------------------------------------------------------------------------------------------------------

def _zip(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", _LEVEL).compress(data, asbytes=True)


def _unzip(data: bytes) -> bytes:
    return pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)


def _planes(x: np.ndarray, bits: int) -> bytes:
    return np.ascontiguousarray(x, U).view(np.uint8).reshape(-1, 8)[:, :(bits + 7) // 8].T.tobytes()


def _from_planes(data: memoryview, m: int, bits: int) -> np.ndarray:
    wide = np.zeros((m, 8), np.uint8)
    wide[:, :(bits + 7) // 8] = np.frombuffer(data, np.uint8).reshape((bits + 7) // 8, m).T
    return wide.view(U).ravel()


def zip_codes(limbs: list[np.ndarray], sizes: list[int], counts: np.ndarray) -> bytes:
    """A filter of sorted distinct codes: quotients in unary, remainders and counts (one byte, larger ones apart)."""
    m, bits = len(counts), sizes[0]
    q = min(bits, max(0, m.bit_length() - 1))
    quotient = (limbs[0] >> U(bits - q)).astype(np.int64) if q else np.zeros(m, np.int64)
    unary = np.zeros(m + (1 << q), np.uint8)
    unary[quotient + np.arange(m)] = 1  # a one for each code, a zero after the codes of each quotient
    many = np.flatnonzero(counts > 254)
    parts = [np.packbits(unary).tobytes(), _planes(limbs[0] & U((1 << (bits - q)) - 1), bits - q)]
    parts += [_planes(k, b) for k, b in zip(limbs[1:], sizes[1:])]
    parts += [np.minimum(counts, 255).astype(np.uint8).tobytes(), counts[many].astype(np.int64).tobytes()]
    return b"".join([m.to_bytes(8, "little"), q.to_bytes(1, "little"), _zip(b"".join(parts))])


def unzip_codes(data: bytes, sizes: list[int]) -> tuple[list[np.ndarray], np.ndarray]:
    m, q, at = int.from_bytes(data[:8], "little"), data[8], 0
    raw, bits = memoryview(_unzip(data[9:])), sizes[0]

    def take(n: int) -> memoryview:
        nonlocal at
        at += n
        return raw[at - n:at]

    unary = np.unpackbits(np.frombuffer(take((m + (1 << q) + 7) // 8), np.uint8), count=m + (1 << q))
    quotient = (np.flatnonzero(unary) - np.arange(m)).astype(U)
    left = _from_planes(take(m * ((bits - q + 7) // 8)), m, bits - q)
    limbs = [(quotient << U(bits - q) if bits > q else quotient) | left if q else left]
    limbs += [_from_planes(take(m * ((b + 7) // 8)), m, b) for b in sizes[1:]]
    counts = np.frombuffer(take(m), np.uint8).astype(np.int64)
    counts[counts == 255] = np.frombuffer(raw[at:], np.int64)
    return limbs, counts


def merge(filters: list[bytes], sizes: list[int]) -> tuple[list[np.ndarray], np.ndarray, list[np.ndarray]]:
    """Sorted distinct codes of many filters, their total counts, and for each filter the places of its codes among them."""
    parts = [unzip_codes(f, sizes) for f in filters]
    codes, place = distinct([np.concatenate([p[0][k] for p in parts]) for k in range(len(sizes))])
    counts = np.zeros(len(codes[0]), np.int64)
    np.add.at(counts, place, np.concatenate([p[1] for p in parts]))
    return codes, counts, np.split(place, np.cumsum([len(p[1]) for p in parts])[:-1])


# Spark ------------------------------------------------------------------------------------------------------------------------

_WORDS = "block bigint, at binary, ids binary, lang string, word string, id bigint, f bigint"
_WORDS_ARROW = pa.schema([("block", pa.int64()), ("at", pa.binary()), ("ids", pa.binary()), ("lang", pa.string()), ("word", pa.string()), ("id", pa.int64()), ("f", pa.int64())])
_SENT = "block bigint, shard int, data binary"
_SENT_ARROW = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("data", pa.binary())])
_MERGED = "block bigint, shard int, data binary, ids array<bigint>, f bigint"
_MERGED_ARROW = pa.schema([*_SENT_ARROW, ("ids", pa.list_(pa.int64())), ("f", pa.int64())])


def _number(least: int, buckets: int):
    """Counts the words of a bucket; numbers the frequent ones, tells the blocks, and gives the words and the languages' totals."""
    def run(group: pa.Table) -> pa.Table:
        bucket = group.column("bucket")[0].as_py()
        words: dict[bytes, int] = {}
        rows = [(r["block"], unzip_ints(r["at"]), np.fromiter((words.setdefault(p, len(words)) for p in unzip_pieces(r["pieces"])), np.int64), unzip_ints(r["learnt"]))
                for r in group.to_pylist()]
        total = np.zeros(len(words), np.int64)
        for _, _, place, n in rows:
            np.add.at(total, place, n.astype(np.int64))
        names, langs, number = list(words), {}, np.zeros(len(words), np.int64)
        is_word = np.array([b"\t" in w for w in names], bool)
        often = [i for i in np.argsort(-total, kind="stable").tolist() if total[i] >= least and is_word[i]]
        number[often] = (1 + np.arange(len(often))) * buckets + bucket
        out = []
        for i in np.flatnonzero(is_word).tolist():
            lang, word = names[i].decode().rsplit("\t", 1)
            langs[lang] = langs.get(lang, 0) + int(total[i])
            if number[i]:
                out.append({"lang": lang, "word": word, "id": int(number[i]), "f": int(total[i])})
        out += [{"lang": lang, "f": n} for lang, n in langs.items()]
        for block, at, place, _ in rows:
            known = np.flatnonzero(number[place])
            if len(known):
                out.append({"block": block, "at": zip_ints(at[known]), "ids": zip_longs(number[place[known]])})
        return pa.Table.from_pylist(out, _WORDS_ARROW)
    return run


def _sequences(blocks: pa.Table, ids: pa.Table) -> pa.Table:
    """Every place of a block as the number of its word, 0 for breaks and words that are not frequent."""
    out = []
    for block, places in zip(blocks.column("block").to_pylist(), blocks.column("places").to_pylist()):
        seq = unzip_ints(places)
        number = np.zeros(int(seq.max()) + 1 if len(seq) else 1, U)
        for at, got in zip(ids.column("at").to_pylist(), ids.column("ids").to_pylist()):
            number[unzip_ints(at)] = unzip_longs(got)
        out.append({"block": block, "seq": zip_longs(number[seq])})
    return pa.Table.from_pylist(out, pa.schema([("block", pa.int64()), ("seq", pa.binary())]))


def _candidates(seq: np.ndarray, often: np.ndarray, n: int, bits: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places where the phrases of n - 1 words here and one place on are frequent, and the codes of the n words there."""
    at = np.flatnonzero(often[:-1] & often[1:])
    return at, scatter(pack([seq[at + j] for j in range(n)], bits), limb_bits(n, bits))


def _send(n: int, bits: int, shards: int):
    """From a block and the answers to its phrases of n - 1 words: its filters of phrases of n words, and where the former begin."""
    def run(blocks: pa.Table, more: pa.Table) -> pa.Table:
        out = []
        for block, raw in zip(blocks.column("block").to_pylist(), blocks.column("seq").to_pylist()):
            seq = unzip_longs(raw)
            often = seq > 0
            if n > 2:
                rows = sorted(zip(more.column("shard").to_pylist(), more.column("data").to_pylist()))
                if n > 3:
                    often = np.unpackbits(np.frombuffer(_unzip(rows[0][1]), np.uint8), count=len(seq)).astype(bool)
                    rows = rows[1:]
                at, codes = _candidates(seq, often, n - 1, bits)
                _, place = distinct(codes)
                answers = [np.unpackbits(np.frombuffer(_unzip(d[8:]), np.uint8), count=int.from_bytes(d[:8], "little")) for _, d in rows]
                yes = np.concatenate([np.zeros(0, np.uint8), *answers]).astype(bool)
                often = np.zeros(len(seq), bool)
                often[at] = yes[place]
                out.append({"block": block, "shard": -1, "data": _zip(np.packbits(often).tobytes())})
            _, codes = _candidates(seq, often, n, bits)
            codes, place = distinct(codes)
            counts, sizes = np.bincount(place, minlength=len(codes[0])), limb_bits(n, bits)
            top = min(shards.bit_length() - 1, sizes[0])
            shard = (codes[0] >> U(sizes[0] - top)).astype(np.int64) if top else np.zeros(len(counts), np.int64)
            edge = np.searchsorted(shard, np.arange((1 << top) + 1))
            codes[0] = codes[0] & U((1 << (sizes[0] - top)) - 1)
            for k in np.unique(shard).tolist():
                s = slice(edge[k], edge[k + 1])
                out.append({"block": block, "shard": k, "data": zip_codes([c[s] for c in codes], [sizes[0] - top, *sizes[1:]], counts[s])})
        return pa.Table.from_pylist(out, _SENT_ARROW)
    return run


def _meet(n: int, bits: int, shards: int, least: int):
    """Merges the filters of a shard; tells each block which of its codes are frequent, and gives these as word numbers."""
    def run(group: pa.Table) -> pa.Table:
        shard, blocks = group.column("shard")[0].as_py(), group.column("block").to_pylist()
        sizes = limb_bits(n, bits)
        top = min(shards.bit_length() - 1, sizes[0])
        codes, counts, places = merge(group.column("data").to_pylist(), [sizes[0] - top, *sizes[1:]])
        often = counts >= least
        out = [{"block": b, "shard": shard, "data": len(p).to_bytes(8, "little") + _zip(np.packbits(often[p]).tobytes())} for b, p in zip(blocks, places)]
        found = [c[often] for c in codes]
        if top:
            found[0] = found[0] | U(shard << (sizes[0] - top))
        ids = unpack(gather(found, sizes), n, bits).astype(np.int64)
        phrases = pa.RecordBatch.from_arrays([pa.nulls(len(ids), pa.int64()), pa.nulls(len(ids), pa.int32()), pa.nulls(len(ids), pa.binary()),
                                              pa.ListArray.from_arrays(pa.array(np.arange(0, n * len(ids) + 1, n, dtype=np.int32)), pa.array(ids.ravel())),
                                              pa.array(counts[often])], schema=_MERGED_ARROW)
        return pa.concat_tables([pa.Table.from_pylist(out, _MERGED_ARROW), pa.Table.from_batches([phrases])])
    return run


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, block: int = SIZE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words, phrases, totals) of ``docs`` (lang, text): words (lang, word, id, f) and phrases (ids, f) found ``least`` times, and the number of words by lang.

    Words are longest runs of characters other than space, tab, line ends and ``.,;:!?``; phrases do not cross line ends or these marks. A-Z
    count as a-z. Null texts are empty, a null lang is ``und``. Repeated rows count each time; other columns are not read.
    """
    spark, lang = docs.sparkSession, F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN_LANG))
    body = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    texts = docs.select(F.lit(None).cast("bigint").alias("doc_id"), F.concat(F.length(lang).cast("string"), F.lit(":"), lang, body).alias("text"))
    chars = docs.agg(F.sum(F.length(F.col("text").cast("string")))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars // PER_SHARD))
    shards = 1 << (buckets - 1).bit_length()
    blocks = packed(texts, find, F.lit(True), block, buckets)
    told = stage(by_bucket(blocks).select("bucket", "block", "pieces", "at", "learnt").groupBy("bucket").applyInArrow(_number(least, buckets), _WORDS), "words")
    words = told.filter("id IS NOT NULL").select("lang", "word", "id", "f")
    totals = told.filter("id IS NULL AND lang IS NOT NULL").groupBy("lang").agg(F.sum("f").alias("n"))
    bits = int(words.agg(F.max("id")).first()[0] or 1).bit_length()
    seq = kept_by(blocks.select("block", "places").groupBy("block").cogroup(told.filter("block IS NOT NULL").select("block", "at", "ids").groupBy("block"))
                  .applyInArrow(_sequences, "block bigint, seq binary"), "block", "sequences")
    more, phrases = spark.createDataFrame([], _SENT), spark.createDataFrame([], "ids array<bigint>, f bigint")
    for n in range(2, longest + 1):
        sent = stage(seq.groupBy("block").cogroup(more.groupBy("block")).applyInArrow(_send(n, bits, shards), _SENT), "filters")
        met = stage(sent.filter("shard >= 0").groupBy("shard").applyInArrow(_meet(n, bits, shards, least), _MERGED), "merged")
        phrases = phrases.unionByName(met.filter("ids IS NOT NULL").select("ids", "f"))
        more = met.filter("block IS NOT NULL").select("block", "shard", "data").unionByName(sent.filter("shard < 0"))
    return words, phrases, totals


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, keep: int = KEEP, percent: int = 100, block: int = SIZE) -> DataFrame:
    """Per lang of ``docs`` (lang, text) the ``keep`` best phrases of 2 to ``longest`` words: lang, rank, phrase, a, l, r, n, score.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its lowest-scoring cut (equal scores: the first), ``n`` the language's words; score is
    ``floor(1000 * a * n / (l * r))``. A phrase inside a longer frequent one that has at least ``percent`` of its count is dropped. By score
    and ``a``, largest first, then by the phrase's bytes. Nulls and repeated rows as in ``frequent_phrases``; no text, no rows.
    """
    words, phrases, totals = frequent_phrases(docs, longest, least, block)
    phrases = stage(phrases, "phrases")
    parts = phrases.unionByName(words.select(F.array("id").alias("ids"), "f"))
    inner = F.expr("""flatten(transform(sequence(2, size(ids) - 1), k -> transform(sequence(1, size(ids) - k + 1), i -> slice(ids, i, k))))""")
    covered = phrases.filter(F.size("ids") > 2).select(F.explode(inner).alias("ids"), F.col("f").alias("g")).groupBy("ids").agg(F.max("g").alias("g"))
    kept = (phrases.join(covered, "ids", "left").filter(F.col("g").isNull() | (F.lit(100) * F.col("g") < F.lit(percent) * F.col("f")))
            .select("ids", F.col("f").alias("a")))
    cuts = (kept.withColumn("k", F.explode(F.expr("sequence(1, size(ids) - 1)")))
            .withColumn("head", F.expr("slice(ids, 1, k)")).withColumn("tail", F.expr("slice(ids, k + 1, size(ids) - k)")))
    cuts = (cuts.join(parts.select(F.col("ids").alias("head"), F.col("f").alias("l")), "head")
            .join(parts.select(F.col("ids").alias("tail"), F.col("f").alias("r")), "tail"))
    known = words.select(F.col("id").alias("first"), "lang").join(totals, "lang")
    exact = "cast({} AS decimal(19, 0))"
    score = F.expr(f"cast((cast({exact.format('a')} * 1000 AS decimal(23, 0)) * cast(n AS decimal(15, 0))) div ({exact.format('l')} * {exact.format('r')}) AS bigint)")
    scored = cuts.withColumn("first", F.col("ids")[0]).join(known, "first").withColumn("score", score)
    least_cut = (scored.groupBy("ids", "lang", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
                 .select("ids", "lang", "a", "n", "cut.score", "cut.l", "cut.r"))
    named = (least_cut.select("*", F.posexplode("ids").alias("at", "id")).join(words.select("id", "word"), "id")
             .groupBy("ids", "lang", "a", "n", "score", "l", "r").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("spelt"))
             .withColumn("phrase", F.concat_ws(" ", F.col("spelt.word"))))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (named.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)
            .select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = rf"""
WITH d AS (SELECT coalesce(lang, '{UNKNOWN_LANG}') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
total AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM w GROUP BY 1),
g AS (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, {LONGEST + 1}) r(k) WHERE len(w) >= k),
f AS (SELECT lang, w[i:i + k - 1] AS ws, count(*)::HUGEINT AS f FROM g GROUP BY 1, 2 HAVING count(*) >= {LEAST}),
sub AS (SELECT lang, f, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM f, range(2, {LONGEST}) r(k) WHERE k < len(ws)),
covered AS (SELECT lang, ws[i:i + k - 1] AS ws, max(f) AS g FROM sub GROUP BY 1, 2),
kept AS (SELECT f.lang, f.ws, f.f AS a FROM f LEFT JOIN covered c ON c.lang = f.lang AND c.ws = f.ws
         WHERE len(f.ws) > 1 AND (c.g IS NULL OR 100 * c.g < 100 * f.f)),
cut AS (SELECT lang, ws, a, unnest(range(1, len(ws))) AS k FROM kept),
scored AS (SELECT c.lang, c.ws, c.a, c.k, x.f AS l, y.f AS r, t.n, (1000 * c.a * t.n) // (x.f * y.f) AS score
           FROM cut c JOIN f x ON x.lang = c.lang AND x.ws = c.ws[1:c.k] JOIN f y ON y.lang = c.lang AND y.ws = c.ws[c.k + 1:] JOIN total t ON t.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1),
ranked AS (SELECT lang, array_to_string(ws, ' ') AS phrase, a, l, r, n, score,
                  row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(ws, ' ')) AS rank FROM best)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= {KEEP}
"""

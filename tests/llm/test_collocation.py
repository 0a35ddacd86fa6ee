import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from monthgrid.llm import collocation as C

U = np.uint64


def brute(rows, longest, least, keep, percent=100):
    """{(lang, rank): rest} from (lang, text) rows."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang, text = "und" if lang is None else lang, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    often = {key: c for key, c in f.items() if c >= least}
    out = {}
    for (lang, g), a in often.items():
        if len(g) < 2 or any(100 * b >= percent * a for (o, h), b in often.items() if o == lang and len(h) > len(g)
                             and any(h[i:i + len(g)] == g for i in range(len(h) - len(g) + 1))):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, g[:k]] * f[lang, g[k:]]), k) for k in range(1, len(g))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), f[lang, g[:k]], f[lang, g[k:]], n[lang]))
    return {(lang, i): (p.decode(), -a, left, right, m, -s) for lang, rows in out.items() for i, (s, a, p, left, right, m) in enumerate(sorted(rows)[:keep], 1)}


def rows_of(df):
    return {(r["lang"], r["rank"]): (r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect()}


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 64), st.integers(1, 6), st.data())
def test_codes_come_back(bits, n, data):
    m = data.draw(st.integers(1, 40))
    words = [np.array(data.draw(st.lists(st.integers(0, (1 << bits) - 1), min_size=m, max_size=m)), U) for _ in range(n)]
    limbs, sizes = C.pack(words, bits), C.limb_bits(n, bits)
    moved = C.scatter(limbs, sizes)
    assert all(int(k.max()) < 1 << b for k, b in zip(moved, sizes))
    assert (C.unpack(C.gather(moved, sizes), n, bits) == np.stack(words, axis=1)).all()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(2, 64), min_size=1, max_size=3), st.data())
def test_filters_are_lossless_and_merge_as_counters(sizes, data):
    totals, filters = Counter(), []
    for _ in range(data.draw(st.integers(1, 4))):
        own = Counter(data.draw(st.dictionaries(st.tuples(*[st.integers(0, (1 << b) - 1) for b in sizes]), st.sampled_from([1, 2, 254, 255, 256, 10**12]), max_size=30)))
        keys = sorted(own)
        limbs = [np.array([k[i] for k in keys], U) for i in range(len(sizes))]
        counts = np.array([own[k] for k in keys], np.int64)
        filters.append(C.zip_codes(limbs, sizes, counts))
        back, n = C.unzip_codes(filters[-1], sizes)
        assert list(zip(*[k.tolist() for k in back])) == keys and n.tolist() == counts.tolist()
        totals.update(own)
    codes, counts, places = C.merge(filters, sizes)
    assert dict(zip(zip(*[k.tolist() for k in codes]), counts.tolist())) == dict(totals) and list(zip(*[k.tolist() for k in codes])) == sorted(totals)
    assert [len(p) for p in places] == [len(C.unzip_codes(f, sizes)[1]) for f in filters]


def test_sorted_codes_are_smaller_than_plain_ones():
    codes = np.unique(np.random.default_rng(1).integers(0, 1 << 34, 50000, dtype=U))
    assert len(C.zip_codes([codes], [34], np.ones(len(codes), np.int64))) < 3.5 * len(codes)


@pytest.mark.parametrize("block, longest, least, keep, percent", [(300, 5, 3, 2000, 100), (40, 4, 2, 7, 60), (1 << 20, 5, 3, 50, 100)])
def test_against_a_plain_count(spark, block, longest, least, keep, percent):
    rng = random.Random(21)
    common = ["the", "of", "in", "a", "new", "york", "city", "été", "x-ray", "日本"]
    rows = []
    for _ in range(150):
        words = [rng.choice(common[:rng.choice([3, 10])]) for _ in range(rng.randint(0, 30))]
        text = "".join(w + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", " "]) for w in words)
        rows.append((rng.choice(["en", "en", "en", "d\te", "", None]), text.title() if rng.random() < 0.2 else text))
    rows += [("en", "new york city new york city"), ("en", "the the the the the the"), ("fr", "solo"), (None, None), ("und", "in a new york"), ("en", "")] * 4
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, text string, id int, word string").repartition(5)
    got = rows_of(C.collocations(df, longest, least, keep, percent, block))
    assert got == brute(rows, longest, least, keep, percent) and len(got) > 20


def test_wide_word_numbers_take_several_limbs(spark, monkeypatch):
    monkeypatch.setattr(C, "PER_SHARD", 1)  # numbers are spread over many buckets
    rng = random.Random(3)
    words = [f"w{i}" for i in range(30)]
    rows = [("en", " ".join(rng.choices(words[k:k + 4], k=60))) for k in range(0, 26) for _ in range(6)]
    df = spark.createDataFrame(rows, "lang string, text string")
    numbers = C.frequent_phrases(df, 2, 20)[0]
    assert C.limb_bits(5, max(r["id"] for r in numbers.collect()).bit_length())[1:]
    got = rows_of(C.collocations(df, 5, 20))
    assert got == brute(rows, 5, 20, 2000) and any(len(v[0].split()) == 5 for v in brute(rows, 5, 3, 10**6).values())


def test_exact_beyond_64_bits(spark):
    got = spark.sql("SELECT cast(4000000000 AS bigint) a, cast(50000000000 AS bigint) n, cast(4000000000 AS bigint) l, cast(4100000000 AS bigint) r").selectExpr(
        "cast((cast(cast(a AS decimal(19, 0)) * 1000 AS decimal(23, 0)) * cast(n AS decimal(15, 0))) div (cast(l AS decimal(19, 0)) * cast(r AS decimal(19, 0))) AS bigint) s").first()[0]
    assert got == 1000 * 4000000000 * 50000000000 // (4000000000 * 4100000000)


def test_empty_table(spark):
    assert C.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0

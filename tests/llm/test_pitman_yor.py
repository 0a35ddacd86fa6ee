import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from monthgrid.llm import pitman_yor as P


def brute(rows):
    words = {i: [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None] for i, (_, t) in enumerate(rows)}
    learns = [i is None or zlib.crc32(str(i).encode()) % 10 != 0 for i, _ in rows]
    c = Counter(w for i, ws in words.items() if learns[i] for w in ws)
    n, v = sum(c.values()), len(c)
    return [(rows[i][0], not learns[i], len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)) for i, ws in words.items()]


def run(spark, rows, tmp_path):
    spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, block string").write.parquet(f"{tmp_path}/documents.parquet")
    return P.op10_pitman_yor(spark, str(tmp_path)).collect()


def test_base_equals_brute_force(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(rng.choice(["The", "cat", "é", "x\x00y", "sat\n", "\x1c", "THE"], rng.integers(0, 30)))) for i in range(80)]
    rows += [(80, None), (81, ""), (None, "the cat"), (5, "twice"), (5, "twice"), (82, "cat " * 5000)]
    got = sorted(([r[k] for k in ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score")] for r in run(spark, rows, tmp_path)), key=str)
    want = sorted(map(list, brute(rows)), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)


def test_empty_table_and_nothing_to_learn(spark, tmp_path):
    assert run(spark, [], tmp_path / "a") == []
    got = run(spark, [(i, "a b") for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0], tmp_path / "b")
    assert got and all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in got)


def test_spelling_probabilities_add_up_to_one():
    words = [b"cat", b"car", b"cart", b"", b"dog", "é".encode()]
    context, symbol, owner = P.spell(words)
    code, at = np.unique(context << 9 | symbol, return_inverse=True)
    n = np.bincount(at, np.array([5, 3, 1, 9, 2, 1])[owner]).astype(np.int64)
    model = P.Spelling(code, n, P.Spelling(code, n, None, 0), 1)
    symbols = np.arange(P.SYMBOLS)
    for c in [0, *np.unique(context), 12345]:
        assert model.probability(np.full(P.SYMBOLS, c), symbols).sum() == pytest.approx(1)
    assert model.words(P.spell([b"cat"]))[0] > 20 * model.words(P.spell([b"zqx"]))[0]


def test_seating_draws_as_many_tables_as_the_process_expects():
    c, base, d = 40, 0.3, 0.6
    seeds = P.W.mix(np.arange(20000, dtype=np.uint64))
    t = P.seat(np.full(20000, c), np.full(20000, (1 + d * 7) * base), np.full(20000, base), d, seeds)
    rng, want = np.random.default_rng(0), []
    for _ in range(4000):
        k = 1
        for j in range(1, c):
            new = (1 + d * (7 + k)) * base
            k += rng.random() < new / (new + j - d * k)
        want.append(k)
    assert t.min() >= 1 and t.max() <= c
    assert t.mean() == pytest.approx(np.mean(want), abs=0.2)
    big = P.seat(np.array([10**7, 0, 1]), np.array([5.0, 5, 5]), np.full(3, 0.01), 0.5, seeds[:3])
    assert 50 < big[0] < 3000 and list(big[1:]) == [0, 1]


def test_held_out_texts_score_better_than_smoothed_counts(spark):
    got = [r for r in P.op10_pitman_yor(spark, "/root/testdata/sf0.001").collect() if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_known_words_and_the_unknown_one_add_up_to_one(spark):
    rows = [(i, f"{w} the cat sat") for i, w in enumerate("a b c d e f g h a a b the the cat dog".split())]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    probes = spark.createDataFrame([(1000 + i, w) for i, w in enumerate("a b c d e f g h the cat sat dog zebra".split())], "doc_id bigint, text string")
    got = {r.doc_id: r.score for r in P.scored(df.union(probes), P.F.col("doc_id") < 1000).collect()}
    end = P.scored(df.union(spark.createDataFrame([(2000, "")], "doc_id bigint, text string")), P.F.col("doc_id") < 1000).filter("doc_id = 2000").first().score
    assert sum(10 ** (got[1000 + i] - end) for i in range(13)) + 10**end == pytest.approx(1, abs=1e-4)


def ordered_texts(spark, n=400):
    rng = np.random.default_rng(5)
    sides = [("the", ["cat", "dog", "sun"]), ("we", ["run", "see", "like"]), ("my", ["hat", "car", "tea"])]
    rows = []
    for i in range(n):
        text = []
        for _ in range(12):
            head, tails = sides[rng.integers(3)]
            text += [head, tails[rng.integers(3)]]
        rows.append((i, " ".join(text)))
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_word_order_moves_the_score(spark):
    docs = ordered_texts(spark)
    rng = np.random.default_rng(6)
    held = [(1000 + r.doc_id, r.text) for r in docs.limit(40).collect()]
    held += [(i + 1000, " ".join(rng.permutation(t.split()))) for i, t in held]
    df = docs.union(spark.createDataFrame(held, "doc_id bigint, text string"))
    got = {r.doc_id: r.score for r in P.scored(df, P.F.col("doc_id") < 1000, order=2).filter("held_out").collect()}
    assert all(got[i] > got[i + 1000] + 2 for i, _ in held[:40])


def test_after_each_word_the_known_words_and_the_unknown_one_add_up_to_one(spark):
    docs = [(i, f"{w} the cat sat") for i, w in enumerate("a b c a a b the the cat dog".split())]
    words = "a b c the cat sat dog zebra".split()
    probes = {"": 1000} | {w: 1001 + i for i, w in enumerate(words)} | {f"{u} {w}": 1100 + 10 * i + j for i, u in enumerate(words) for j, w in enumerate(words)}
    df = spark.createDataFrame(docs + [(i, t) for t, i in probes.items()], "doc_id bigint, text string")
    got = {r.doc_id: 10**r.score for r in P.scored(df, P.F.col("doc_id") < 1000, order=2).collect()}
    p = {t: got[i] for t, i in probes.items()}
    # up to a change of scale of the states (the end, then the words), m holds P(next | before); rows that add up to one make 1 its largest eigenvalue
    m = np.ones((len(words) + 1, len(words) + 1))
    m[0] = [p[""], *(p[w] for w in words)]
    m[1:, 1:] = [[p[f"{u} {w}"] / p[u] for w in words] for u in words]
    assert max(abs(np.linalg.eigvals(m))) == pytest.approx(1, abs=1e-4)
    assert p["the cat"] * p["sat"] > 2 * p["the sat"] * p["cat"]


def test_scored_buckets_and_blocks_are_not_shuffled_again(spark):
    plan = P.op10_pitman_yor(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(moved) == 3 and plan.count("FlatMapCoGroupsInArrow") == 2, moved  # contexts to their homes and back, what blocks need to the blocks


def test_a_small_corpus_has_few_homes_and_buckets(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(P, "with_pairs", lambda *a, made=P.with_pairs: asked.append(a[1]) or made(*a))
    monkeypatch.setattr(P, "_sweep", lambda *a, made=P._sweep: asked.append(a[-1]) or made(*a))
    most = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        P.scored(spark.createDataFrame([(1, "the cat"), (2, "the dog")], "doc_id bigint, text string"), P.F.lit(True), burn=0, keep=1, order=2).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", most)
    assert set(asked) == {1}


def test_places_point_at_the_words_and_pairs_of_every_block(spark, monkeypatch):
    monkeypatch.setattr(P, "_HELD", 3)  # merges and looks pairs up in steps
    texts = ["a b a b c", "b a c", "x a b", "c c c a", "", "a b"]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id bigint, text string").repartition(3)
    blocks = P.packed(docs, P.tokens, P.F.col("doc_id") != 2, 8, dealt=False)
    parts = P.with_pairs(blocks, 2, P._hash)
    rows = parts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(P._vocabulary(2), P.VOCABULARY).collect()
    want = Counter((w, u) for i, t in enumerate(texts) if i != 2 for u, w in zip(["", *t.split()], [*t.split(), ""]))
    got, sent = {}, 0
    for r in (r for r in rows if r.block is None):
        words, n, times = P.unzip_pieces(r.words), P.unzip_ints(r.sizes), P.unzip_counts(r.times)
        contexts, at = P.unzip_longs(r.contexts), P.unzip_ints(r.context_at)
        of = dict(zip(P._hash([b"", b"a", b"b", b"c", b"x"]).tolist(), ["", *"abcx"]))
        pairs = [(w, of[int(contexts[i])]) for w, i in zip(np.repeat([w.decode() for w in words], n).tolist(), at)]
        got |= dict(zip(pairs, times.tolist()))
        mine = {p.block: p for p in parts.filter(f"bucket = {r.bucket}").collect()}
        for p in (p for p in rows if p.block is not None and p.bucket == r.bucket):
            part = mine[p.block]
            assert [words[i] for i in P.unzip_steps(p.word_at)] == P.unzip_pieces(part.pieces)
            before = P.unzip_longs(part.contexts)[P.unzip_steps(part.context_at)]
            owner = np.repeat([w.decode() for w in P.unzip_pieces(part.pieces)], P.unzip_ints(part.sizes)).tolist()
            for w, u, i in zip(owner, before.tolist(), P.unzip_steps(p.pair_at).tolist()):
                assert (pairs[i - 1] if i else None) == ((w, of[u]) if (w, of[u]) in want else None)
                sent += 1
    assert got == want and sent


def test_counts_steps_and_distinct_numbers_come_back():
    from monthgrid.llm import blocks as B
    rng = np.random.default_rng(3)
    for x in ([], [0], [0, 0], [255, 1], [2**40, 3], rng.integers(0, 70000, 500)):
        assert B.unzip_counts(B.zip_counts(np.array(x, np.uint64))).tolist() == list(x)
    for x in ([], [5, 3, 2**32 - 1, 0], rng.integers(0, 2**32, 500)):
        assert B.unzip_steps(B.zip_steps(np.array(x, np.int64))).tolist() == list(x)
    for x in (np.zeros(0, np.int64), rng.integers(0, 20, 500), rng.integers(2**61, 2**62, 50)):
        assert all((a == b).all() for a, b in zip(B.distinct(x), np.unique(x, return_inverse=True)))

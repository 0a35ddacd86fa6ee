import random
import re

import numpy as np

from monthgrid.llm import near_dup as N


def brute(rows, percent=85):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for i, t in rows}
    sets = {i: {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for i, w in words.items()}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def run(spark, rows, percent=85):
    df = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id bigint, text string, key string").repartition(3)
    return {r[0]: tuple(r[1:]) for r in N.near_duplicates(df, percent).collect()}


def family(rng, base, n, most):
    """Copies of a text, each with its own edits, some of them copies of copies."""
    out = [base]
    for _ in range(n):
        w = list(rng.choice(out[-5:] if rng.random() < 0.3 else out[:1]))
        for _ in range(rng.randint(0, most)):
            k = rng.randrange(len(w))
            w[k:k + 1] = rng.choice([[], ["new%d" % rng.randrange(50)], [w[k], "and"]])
        out.append(w)
    return [" ".join(w) for w in out]


def test_equals_brute_force_on_families_copies_and_odd_texts(spark):
    rng = random.Random(4)
    texts = [None, "", " \n ", "one", "One", "two words", "two  words", "a b c d", "a b c d e", "A B C D E", "x " * 3000, "x " * 10]
    for size, most in ((30, 4), (80, 6), (200, 12)):
        texts += family(rng, ["w%d" % rng.randrange(400) for _ in range(size)], 45, most)
    texts += family(rng, ["v%d" % rng.randrange(4000) for _ in range(900)], 12, 60)
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, 80) == brute(rows, 80)


def test_repeated_rows_and_missing_ids(spark):
    text = "the same eight words in every one row"
    df = spark.createDataFrame([(3, text), (3, text), (2, text), (None, text), (None, "alone in the world it is here"), (9, None)], "doc_id bigint, text string")
    got = sorted((tuple(r) for r in N.near_duplicates(df).collect()), key=str)
    assert got == sorted([(3, 4, 2, False), (3, 4, 2, False), (2, 4, 2, True), (None, 4, 2, False), (None, 3, None, True), (9, 0, 9, True)], key=str)


def test_empty_table(spark):
    assert N.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_signatures_within_the_distance_share_a_key():
    rng = np.random.default_rng(5)
    for _ in range(200):
        a = rng.integers(0, 2**16, N.VALUES).astype(np.uint16)
        b = a.copy()
        wrong = rng.choice(N.VALUES, 2 * N.CHUNKS - 1, replace=False)
        b[wrong] += 1
        x, y = N.chunk_keys(np.stack([a, b]))
        assert len(x) == N.VALUES and set(x) & set(y)


def test_components_of_long_chains_and_loops(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100), (101, 100), (103, 102), (101, 103), (None, 5), (7, 6)]
    got = {r["id"]: r["component"] for r in N.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100, 102: 100, 103: 100}
    assert N.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def two_families(rng, m, size=300):
    """Two families of one-word edits whose bases are just below the threshold."""
    base = ["w%d" % k for k in range(size)]
    other = list(base)
    for k in range(20, size, size // 6):
        other[k] = "o%d" % k
    out = []
    for words in (base, other):
        for _ in range(m):
            w = list(words)
            w[rng.randrange(size)] = "new%d" % rng.randrange(10**6)
            out.append(" ".join(w))
    return out


def test_families_that_share_a_hub_take_pairs_in_proportion(spark, monkeypatch):
    compared, plain = [], N._compared

    def counted(pairs, docs, percent, label):
        out = plain(pairs, docs, percent, label)
        compared.append(out.count())
        return out

    monkeypatch.setattr(N, "_compared", counted)
    for m in (40, 80):
        compared.clear()
        rows = list(enumerate(two_families(random.Random(m), m), 1))
        star = spark.createDataFrame([(i, 1) for i, _ in rows[1:]], "a bigint, b bigint")  # one hub for both
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
        links = [tuple(r) for r in N.linked_stars(star, docs, 85).collect()]
        assert len(N.components(spark.createDataFrame(links, "a bigint, b bigint")).groupBy("component").count().collect()) == 2
        assert sum(compared) <= 5 * 2 * m, (m, compared)


def test_groups_as_stars_equal_brute_force(spark, monkeypatch):
    rng = random.Random(6)
    texts = two_families(rng, 12) + [t for size, most in ((40, 5), (120, 14)) for t in family(rng, ["w%d" % rng.randrange(400) for _ in range(size)], 30, most)]
    rows = list(enumerate(texts))
    monkeypatch.setattr(N, "linked_stars", lambda star, docs, percent, plain=N.linked_stars: plain(star, docs, percent, small=2, rounds=3))
    assert run(spark, rows) == brute(rows)
    monkeypatch.undo()
    monkeypatch.setattr(N, "linked_stars", lambda star, docs, percent, plain=N.linked_stars: plain(star, docs, percent, small=0, rounds=9))
    assert run(spark, rows, 80) == brute(rows, 80)

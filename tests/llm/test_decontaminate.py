import hashlib
import random
import re

from monthgrid.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[k:k + 13]), set()).add(str(i))
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k:k + size]) in windows:
                    hit |= set(range(k, k + size))
                    found |= windows[tuple(w[k:k + size])]
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def run(spark, docs, items):
    d = spark.createDataFrame([(*x, "z") for x in docs], "doc_id bigint, text string, item_id string").repartition(3)
    b = spark.createDataFrame([(*x, "z") for x in items], "item_id bigint, text string, row string")
    return sorted(map(tuple, D.contamination(d, b).collect()), key=str)


def test_equals_brute_force(spark):
    rng = random.Random(9)
    pick = lambda n: [rng.choice(["The", "cat", "sat", "on", "mat", "é1", "dog"]) for _ in range(n)]
    items = [(i, " ".join(pick(rng.choice([3, 5, 12, 13, 14, 30])))) for i in range(40)] + [(40, None), (41, "..."), (42, "onlyone"), (3, "again an item of three")]
    docs = []
    for i in range(120):
        w = pick(rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            w += words(rng.choice(items)[1]) * rng.randint(1, 2) + pick(rng.randint(0, 5))
        docs.append((i, "-".join(w) if i % 3 else " ".join(w).upper()))
    docs += [(200, None), (201, ""), (None, items[0][1]), (5, docs[5][1]), (202, "onlyone " * 4000), (203, "x " * 9000 + " ".join(words(items[5][1])))]
    assert run(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a b")]) == []
    assert run(spark, [(1, "a b")], []) == brute([(1, "a b")], [])


def test_every_shared_span_shares_a_fingerprint():
    rng = random.Random(10)
    for _ in range(100):
        span = [f"w{rng.randrange(6)}" for _ in range(D.SPAN)]
        a, b = ([f"x{rng.randrange(6)}" for _ in range(rng.randint(0, 20))] + span + [f"y{rng.randrange(6)}" for _ in range(rng.randint(0, 20))] for _ in "ab")
        marks = [set(D.winnow(D.W.split([" ".join(t).encode()], D.W.ALNUM))[1].tolist()) for t in (a, b)]
        assert marks[0] & marks[1]

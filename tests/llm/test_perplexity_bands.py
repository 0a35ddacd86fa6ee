import random

import numpy as np

from monthgrid.llm import perplexity as P


def test_both_sides_of_a_band_reject_and_near_copies_stay(spark):
    """A word is followed by its usual one half of the time; a text that always takes the usual one lies below the band."""
    rng = random.Random(3)

    def chain(n, usual):
        at, out = rng.randrange(2000), []
        for _ in range(n):
            out.append(f"w{at}")
            at = (at + (1 if rng.random() < usual else rng.randrange(2000))) % 2000
        return out

    docs = {i: chain(rng.randint(70, 120), 0.5) for i in range(300)}
    flat = {1000 + i: chain(100, 1.0) for i in range(6)}
    odd = {2000 + i: rng.sample(docs[i], len(docs[i])) for i in range(6)}
    near = {}
    for i in range(60):
        words = list(docs[20])
        words[rng.randrange(len(words))] = f"n{i}"
        near[3000 + i] = words
    rows = [(k, " ".join(w), "xx") for x in (docs, flat, odd, near) for k, w in x.items()]
    got = {r.doc_id: r for r in P.judged(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert not any(got[k].kept for k in [*flat, *odd] if not got[k].base_failed) and not all(got[k].base_failed for k in flat)
    assert all(got[k].kept for k in near)
    assert sum(got[k].kept for k in docs) >= 290


def test_the_count_that_three_quarters_of_the_pairs_reach():
    text = np.repeat([0, 1, 3], [8, 8, 1])
    rest = np.array([0, 0, 0, 9, 9, 9, 9, 9, 0, 4, 2, 2, 2, 7, 2, 9, 3])
    assert P.shared_by_all(text, rest, 4).tolist() == [0, 2, 0, 3]


def test_sketches_are_the_least_runs_of_each_text():
    texts = [b"", b"a b", b"A b c d e", b"a b c d e", b"x y " * 300, " ".join(map(str, range(500))).encode()]
    got = P.sketches(texts)
    assert [len(x) for x in got] == [0, 0, 1, 1, 2, 8] and got[2] == got[3]
    assert P.sketches(texts[-1:]) == got[-1:]


def test_pairs_come_back_and_take_fewer_bytes_than_their_hashes():
    rng = np.random.default_rng(4)
    words = np.sort(rng.choice(2**32, 3000, replace=False).astype(np.uint64))
    codes = np.unique(words[rng.zipf(1.3, 40_000) % 3000] << np.uint64(32) | words[rng.zipf(1.3, 40_000) % 3000])
    for some in (codes, codes[:1], codes[-2:], np.array([0, 1, 2**32, 2**64 - 1], np.uint64)):
        assert (P._unzip_pairs(P._zip_pairs(some)) == some).all()
    assert sum(map(len, P._zip_pairs(codes))) < 3 * len(codes)


def test_block_words_come_back_and_take_fewer_bytes_than_their_hashes():
    words = np.random.default_rng(5).choice(2**32, 60_000, replace=False).astype(np.uint32)
    words = np.concatenate([np.sort(words[:100]), np.sort(words[100:])])
    for some in (words, words[:1], words[:0]):
        assert (P._unzip_words(P._zip_words(some)) == some).all()
    assert len(P._zip_words(words)) < 3 * len(words)

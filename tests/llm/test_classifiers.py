"""Toxicity, importance resampling and perplexity bands on small made-up tables."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from monthgrid.llm import perplexity as P
from monthgrid.llm import resample as R
from monthgrid.llm import toxicity as T

CLEAN = "the of and to a in that it was he for on are as with his they at be this from have or by one had".split()


def tables(spark, tmp, docs, labels):
    spark.createDataFrame([(*d, "x") for d in docs], "doc_id bigint, text string, lang string, score string").write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp}/labels.parquet")
    return str(tmp)


def sentence(rng, n):
    return " ".join(rng.choice(CLEAN) for _ in range(n))


# ---- toxicity ----

def test_held_out_toxic_texts_are_found(spark, tmp_path):
    rng, docs, labels = random.Random(1), [], []
    for i in range(400):
        bad = i % 4 == 0
        words = sentence(rng, rng.randint(5, 60)).split()
        if bad:
            words.insert(rng.randrange(len(words)), rng.choice(["Zorgwit", "PLONKER,", "numbskull"]))
        docs.append((i, " ".join(words), "en"))
        labels.append((i, 1, int(bad)))
    docs += [(400, None, "en"), (401, "", None), (None, "numbskull", "en"), (402, "the " * 300000 + "numbskull", "en"), (3, docs[3][1], "en")]
    labels += [(5, None, None), (None, 1, 1), (7, 1, 0)]
    got = T.op2_toxicity(spark, tables(spark, tmp_path, docs, labels)).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    right = [r.predicted == int(r.doc_id % 4 == 0) for r in got if r.held_out and r.doc_id < 400]
    assert np.mean(right) > 0.95
    assert {r.doc_id: r.predicted for r in got}[402] == 1  # the word is at the end of a long text


def test_toxicity_without_labels_or_with_one_class(spark, tmp_path):
    docs = [(i, "a b c d", "en") for i in range(20)]
    assert {r.score < 0.01 for r in T.op2_toxicity(spark, tables(spark, tmp_path / "a", docs, [])).collect()} == {True}
    assert {r.predicted for r in T.op2_toxicity(spark, tables(spark, tmp_path / "b", docs, [(i, 1, 1) for i in range(20)])).collect()} == {1}
    assert T.op2_toxicity(spark, tables(spark, tmp_path / "c", [], [])).count() == 0


def test_features_do_not_depend_on_the_step(monkeypatch):
    rng = random.Random(2)
    text = sentence(rng, 500)
    whole = T.features(text, np.zeros(1 << T.BITS, bool))
    monkeypatch.setattr(T, "STEP", 37)
    assert np.array_equal(whole, T.features(text, np.zeros(1 << T.BITS, bool)))
    assert len(T.features(None, np.zeros(1 << T.BITS, bool))) == 0


# ---- importance resampling ----

def brute_weight(text, ratio):
    words = re.findall(r"[A-Za-z0-9\x80-\U0010ffff]+|[^A-Za-z0-9\x80-\U0010ffff\x20\x09-\x0D]+", text or "")
    slots, _ = R.tokens([(text or "").encode()])
    assert len(slots) == len(words) + max(0, len(words) - 1)
    return sum(ratio[s] for s in slots)


def test_weights_equal_a_plain_sum_and_k_rows_are_drawn(spark, tmp_path):
    rng = random.Random(3)
    docs = [(i, sentence(rng, 30) if i % 5 else "### %% " * (9 + i // 5), "en") for i in range(200)] + [(200, None, "en"), (201, "", "en"), (None, "the of", "en")]
    labels = [(i, int(i % 5 > 0), 0) for i in range(0, 120)]
    sf = tables(spark, tmp_path, docs, labels)
    d, lab = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = R.drawn(d, lab).collect()
    assert len(rows) == 203
    chosen = {r.doc_id for r in rows if r.selected}
    assert {i for i in range(200) if i % 5} <= chosen and not {i for i in range(0, 200, 5)} & chosen
    assert {r.log_weight for r in rows if r.doc_id in (200, 201)} == {0.0}
    k = R.drawn(d, lab, k=50).filter("selected").collect()
    assert len(k) == 50 and min(r.key for r in k) >= sorted((r.key for r in rows), reverse=True)[49] - 1e-9
    ratio = R.log_ratio(np.arange(R.BUCKETS) % 7, np.arange(R.BUCKETS) % 5)
    weigh = R.weight(ratio, spark)
    for r in d.select("text", weigh("text").alias("w")).limit(20).collect():
        assert r.w == pytest.approx(brute_weight(r.text, ratio), abs=1e-9)
    assert sorted(map(str, R.selected(d, lab).select("doc_id").collect())) == sorted(map(str, [r for r in R.drawn(d, lab).filter("selected").select("doc_id").collect()]))


def test_kth_largest_with_ties_and_many_rows(spark):
    values = [float(i % 9000) for i in range(20000)] + [1e9, -5.0]
    df = spark.createDataFrame([(v,) for v in values], "x double").cache()
    for k in (1, 2, 777, 15000, 20001, 20002):
        assert R.kth_largest(df, "x", k) == sorted(values, reverse=True)[k - 1]
    assert R.kth_largest(df, "x", 20003) == -math.inf and R.kth_largest(df, "x", 0) == math.inf
    same = spark.createDataFrame([(2.0,)] * 9000, "x double")
    assert R.kth_largest(same, "x", 5000) == 2.0


def test_resampling_without_labels_keeps_by_noise_only(spark, tmp_path):
    sf = tables(spark, tmp_path, [(i, "a b", "en") for i in range(30)], [])
    rows = R.drawn(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"), k=10).collect()
    assert sum(r.selected for r in rows) == 10 and {r.log_weight for r in rows} == {0.0}
    empty = tables(spark, tmp_path / "e", [], [])
    assert R.op3_importance_resampling(spark, empty).count() == 0


# ---- perplexity ----

def brute_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    inside = set()
    for i in range(len(words) - 4):
        if grams[tuple(words[i:i + 5])] > 1:
            inside |= set(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside)


def test_base_counts_equal_brute_force(spark):
    rng = random.Random(6)
    texts = ["", "a", " \n ", "a b c d e a b c d e", "x y\nx y\n\n \n \nx y", "é ü\x0b#\x1c", "x " * 5000, "\0 \0"]
    texts += ["".join(rng.choice("ab é\n#\t") for _ in range(rng.randint(0, 300))) for _ in range(200)]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate([None, *texts])], "doc_id bigint, text string, lang string")
    got = {r.doc_id: r for r in P.judged(df).collect()}
    for i, t in enumerate([None, *texts]):
        want = brute_base(t)
        assert tuple(got[i][c] for c in P.COUNTS) == want, (i, t)
        failed = want[0] < 10 or 100 * want[4] > 20 * want[0]
        assert got[i].base_failed == failed and not (failed and got[i].kept)


def plain_tokens(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return [*words, None] if words else []


class PlainKneserNey:
    """Pairs over single words, interpolated; discounts and vocabulary may come from a larger corpus."""

    def __init__(self, texts, of=None):
        self.pairs = Counter(p for t in texts for p in zip(["<s>", *t], t))
        self.ends = Counter(w for _, w in self.pairs)
        def found(counts):
            return P.discounts([sum(c == k for c in counts.values()) for k in (1, 2, 3, 4)])
        self.d2, self.d1, self.kinds = (of.d2, of.d1, of.kinds) if of else (found(self.pairs), found(self.ends), len(self.ends))

    def low(self, w):
        n = sum(self.ends.values())
        if not n:
            return 1 / self.kinds
        left = sum(self.d1[min(c, 3)] for c in self.ends.values())
        return (self.ends[w] - self.d1[min(self.ends[w], 3)]) / n + left / n / self.kinds

    def p(self, v, w):
        same = [c for (x, _), c in self.pairs.items() if x == v]
        if not same:
            return self.low(w)
        c = self.pairs[v, w]
        return (c - self.d2[min(c, 3)] + sum(self.d2[min(x, 3)] for x in same) * self.low(w)) / sum(same)


def test_scores_equal_a_plain_kneser_ney_without_the_text_and_its_copies(spark):
    rng = random.Random(7)
    texts = [" ".join(rng.choice("a b c d e The the Of of x y z".split()) for _ in range(rng.randint(1, 25))) for _ in range(25)]
    texts += [texts[0], texts[3], texts[3], "", None, " \n ", "only here and here", "A a a a a a", "é\x0b\u00a0 ß\tc"]
    rows = [(i, t, ("en", "fr", None)[i % 3]) for i, t in enumerate(texts)] + [(None, "alone in its language", "de"), (90, texts[3], "en")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, lang string, digest string")
    for size, bucket in ((1 << 20, 1 << 20), (150, 90)):  # one block and bucket, or many
        got = {(r.doc_id, r.lang): r for r in P.scored(df, size, bucket).collect()}
        assert len(got) == len(rows)
        for key, text, lang in rows:
            corpus = [(t, plain_tokens(t)) for _, t, x in rows if x == lang]
            rest = PlainKneserNey([w for t, w in corpus if t != text], PlainKneserNey([w for _, w in corpus]))
            tokens = plain_tokens(text)
            assert got[key, lang].n_tokens == len(tokens)
            if not tokens:
                assert got[key, lang].log_perplexity is None
                continue
            want = -sum(math.log(rest.p(v, w)) for v, w in zip(["<s>", *tokens], tokens)) / len(tokens)
            assert got[key, lang].log_perplexity == pytest.approx(want, rel=1e-9), (key, text)


def test_the_plain_model_is_a_distribution():
    model = PlainKneserNey([plain_tokens(t) for t in ("a b a c", "b a", "c c a b d")])
    for v in ["<s>", *"abcd", "unseen"]:
        assert sum(model.p(v, w) for w in [*"abcd", None]) == pytest.approx(1)


def chain(rng, words, n):
    """Text in which a word is followed by one of four."""
    at, out = rng.randrange(len(words)), []
    for _ in range(n):
        out.append(words[at])
        at = (at * 7 + rng.randrange(4) + 1) % len(words)
    return out


def test_shuffled_and_foreign_texts_are_rejected_and_copies_stay(spark):
    rng = random.Random(8)
    en, fr = [f"e{i}" for i in range(300)], [f"f{i}" for i in range(300)]
    docs = [(i, " ".join(chain(rng, en if i % 2 else fr, rng.randint(70, 120))), "en" if i % 2 else "fr") for i in range(400)]
    shuffled, foreign = {}, {}
    for i in range(10):
        words = docs[i][1].split()
        rng.shuffle(words)
        shuffled[1000 + i] = (1000 + i, " ".join(words), docs[i][2])
        foreign[2000 + i] = (2000 + i, " ".join(chain(rng, en if docs[i][2] == "fr" else fr, 90)), docs[i][2])
    copies = [(3000 + i, docs[20][1], docs[20][2]) for i in range(150)]
    junk = [(4000 + i, " ".join("".join(rng.choice("qxzjk0123$") for _ in range(6)) for _ in range(60)), "en") for i in range(5)]
    df = spark.createDataFrame([*docs, *shuffled.values(), *foreign.values(), *copies, *junk], "doc_id bigint, text string, lang string")
    kept = {r.doc_id for r in P.judged(df).filter("kept").collect()}
    assert not kept & (set(shuffled) | set(foreign) | {4000 + i for i in range(5)})
    assert {r[0] for r in copies} <= kept
    assert len(kept & set(range(400))) >= 396
    empty = P.judged(df.limit(0))
    assert empty.count() == 0 and empty.columns == ["doc_id", *P.COUNTS, "base_failed", "kept", "log_perplexity"]


def test_string_ids_no_language_and_a_long_text(spark):
    df = spark.createDataFrame([("a", "one two three " * 200000), ("b", "one two three four"), ("b", "one two three four"), (None, None)], "doc_id string, text string")
    got = P.judged(df).collect()
    assert sorted((str(r.doc_id), r.n_words, r.base_failed) for r in got) == [("None", 0, True), ("a", 600000, True), ("b", 4, True), ("b", 4, True)]

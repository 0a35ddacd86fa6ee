"""The stages over small documents, against plain versions of what each decides."""

import hashlib

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
public_tokenizers = pytest.importorskip("public_tokenizers")
import corpus_pipeline as C  # noqa: E402
import tiktoken  # noqa: E402
from monthgrid.llm import bpe  # noqa: E402
from test_near_dup import brute as groups  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SF = "/root/testdata/sf0.001"


def test_stage_names_and_order():
    assert len(C.STAGES) == 5 and C.ORACLE_SQL is None


def test_each_stage_on_its_predecessors_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before = {r["doc_id"]: r for r in docs.collect()}
    kept = C.stage(C.quality(spark, docs, SF), "t")
    assert kept.columns == COLUMNS
    ids = {r["doc_id"] for r in kept.collect()}
    good = {i for i in before if labels.get(i) == 1}
    assert len(good & ids) >= 0.95 * len(good)
    assert all(tuple(r) == tuple(before[r["doc_id"]]) for r in kept.collect())

    single = C.stage(C.near_duplicates(spark, kept, SF), "t")
    want = {i for i, (_, _, stays) in groups([(r["doc_id"], r["text"]) for r in kept.collect()], C.SIMILAR).items() if stays}
    assert single.columns == COLUMNS and {r["doc_id"] for r in single.collect()} == want

    clean = C.stage(C.decontamination(spark, single, SF), "t")
    bad = {r["doc_id"] for r in C.decontaminate.contamination(single, spark.read.parquet(f"{SF}/benchmark.parquet")).filter("contaminated").collect()}
    assert clean.columns == COLUMNS and {r["doc_id"] for r in clean.collect()} == want - bad

    safe = C.stage(C.personal_data(spark, clean, SF), "t")
    assert safe.columns == COLUMNS and {r["doc_id"] for r in safe.collect()} == want - bad
    for r in safe.collect():
        assert r["n_chars"] == len(r["text"]) and "@mail" not in r["text"]

    path, pattern = bpe.tokenizer()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    got = {r["doc_id"]: r for r in C.tokens(spark, safe, SF).collect()}
    assert len(got) == safe.count()
    for r in safe.collect():
        ids = library.encode_ordinary(r["text"])
        assert got[r["doc_id"]]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_stages_on_odd_rows(spark):
    rows = [(1, "a few clean words in a line that go on and on without end", "en", "s", 5, "x"), (1, None, None, None, None, None), (None, "no id here 1.2.3.4", "en", None, 1, "y"),
            (None, None, None, None, None, None), (2, "", "", "", 0, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string")
    for docs in (docs, docs.limit(0)):
        for name, step in C.STAGES[1:-1]:
            out = step(spark, docs, SF)
            assert out.columns == docs.columns
            docs = C.stage(out, "t")
        assert C.tokens(spark, docs, SF).count() == docs.count()

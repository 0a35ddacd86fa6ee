import gc
import hashlib
import os
import random
import weakref
from types import SimpleNamespace

import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
import tiktoken  # noqa: E402
from monthgrid.llm import blocks, bpe  # noqa: E402

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
RANKS = bpe.read_ranks(PATH)
ORACLE = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
ODD = ["", " ", "a", "\n\n  x", "don't we'll", "tab\t\t end ", "\x1c\x1d a\x85b\xa0\xa0c　d", "日本語テキスト 12345 ٣٤", "🙂🙂🙂 é",
       "<|endoftext|>", "a" * 5000, "ab" * 3000, "=" * 777 + " " * 301 + "\n", "x" * 63 + " " + "x" * 64 + " " + "y" * 65]


def rows(df):
    return [(r["doc_id"], list(r["ids"])) for r in df.collect()]


def test_merge_matches_library_on_short_and_long_pieces():
    rng = random.Random(3)
    for n in [*range(1, 90), 300, 2000]:
        piece = "".join(rng.choice("abeinst") for _ in range(n)).encode()
        assert bpe.merge(piece, RANKS) == ORACLE._encode_single_piece(piece)
        if n > 1 and piece not in RANKS:
            assert bpe._merge_long(piece, RANKS) == ORACLE._encode_single_piece(piece)


def test_encode_and_decode_odd_texts(spark):
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choice("ab c\n\té1'#$ ") for _ in range(rng.randint(1, 400))) for _ in range(60)]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(3, texts[3], None), (None, None, None)],
                               "doc_id bigint, text string, block string").repartition(3)
    enc = bpe.encode(df, PATH, PATTERN, block=600)
    got = rows(enc)
    want = [(i, ORACLE.encode_ordinary(t)) for i, t in enumerate(texts)] + [(3, ORACLE.encode_ordinary(texts[3])), (None, [])]
    assert sorted(got, key=str) == sorted(want, key=str)
    dec = bpe.decode(enc, PATH).collect()
    assert sorted((bytes(r["decoded"]) for r in dec)) == sorted([t.encode() for t in texts] + [texts[3].encode(), b""])


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert bpe.decode(bpe.encode(df, PATH, PATTERN), PATH).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_registered_query_over_a_table(spark):
    got = {r["doc_id"]: r for r in bpe.op1_byte_bpe(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = ORACLE.encode_ordinary(d["text"] or "")
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((d["text"] or "").encode()).hexdigest()


def test_a_packed_block_leaves_no_pieces_behind(monkeypatch):
    """Each block's list of pieces was part of a cycle, and stayed until Python looked for cycles."""
    class Piece(str):
        pass

    def find(text):
        out = [Piece(w) for w in text.split()]
        held.extend(map(weakref.ref, out))
        return out

    held = []
    monkeypatch.setattr(blocks.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 0))
    texts = [f"a{k} b{k}" for k in range(20)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(20)), "text": texts, "learns": [True] * 20})
    gc.disable()
    try:
        got = list(blocks._pack(find, 3, 10, pa.int64())(iter([batch])))
        assert len(got) > 1 and not any(r() for r in held)
    finally:
        gc.enable()
    assert [[d["doc_id"] for d in b.column("docs").to_pylist()[0]] for b in got] == [[k] if k > 9 else [k, k + 1] for k in [*range(0, 10, 2), *range(10, 20)]]

import gc
import hashlib
import os
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
import sentencepiece  # noqa: E402
from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402
from monthgrid.llm import pieces as P  # noqa: E402

PATH = public_tokenizers.path("piece_bpe_32k.model")
ORACLE = sentencepiece.SentencePieceProcessor(model_file=PATH)
MODEL = P.read_model(PATH)
ODD = ["", " ", "  ", "a", "\n\n  x", " don't  we'll ", "tab\t\t end ", "\x1c a\x85b\xa0\xa0c　d", "日本語テキスト 12345 ٣٤", "🙂🙂🙂 é", "▁a▁ ▁", "<s>a</s><0x0A><unk>",
       "\x00a", "a" * 5000, "ab" * 3000, "=" * 777 + " " * 301 + "\n", " " * 900, "x" * 255 + " " + "the" * 86 + " " + "y" * 257, "\U0010ffff" * 300, "word " * 400]


def own(text):
    return [i for row in P._Store(MODEL).ids(P.MARK + text.replace(" ", P.MARK)) for i in row.tolist()] + [2] if text else [2]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts_as_the_library(text):
    assert own(text) == ORACLE.encode(text, add_eos=True)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(codec="utf-8") | st.sampled_from("aeinst  \n▁the0=-"), max_size=120))
def test_any_text_as_the_library(text):
    assert own(text) == ORACLE.encode(text, add_eos=True)


def test_rounds_and_queue_agree():
    rng = random.Random(4)
    for n in [*range(2, 60), 200, 500]:
        word = P.MARK * rng.choice([0, 1, 2, 7]) + "".join(rng.choice("abeinsth=") for _ in range(n))
        sym = MODEL.char[[ord(c) for c in word]]
        assert P.merge_queue(MODEL, sym).tolist() == P.merge_rounds(MODEL, sym, np.zeros(len(sym), np.int64))[0].tolist()


def test_hasty_pieces_merge_one_at_a_time():
    """A toy model in which "ab" at once forms "aba", which comes before any other "ab"."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(PATH, "rb") as f:
        proto.ParseFromString(f.read())
    base = [p for p in proto.pieces if p.type != 1]
    del proto.pieces[:]
    proto.pieces.extend(base)
    for s, score in (("a", -9), ("b", -9), (P.MARK, -9), ("ab", -2), ("aba", -1), ("ba", -3)):
        proto.pieces.add(piece=s, score=score, type=1)
    proto.trainer_spec.vocab_size = len(proto.pieces)
    import tempfile

    with tempfile.NamedTemporaryFile(suffix=".model", dir="/tmp") as f:
        f.write(proto.SerializeToString())
        f.flush()
        toy, library = P.read_model(f.name), sentencepiece.SentencePieceProcessor(model_file=f.name)
        for text in ("abab", "ababab", "ababababa", "bababa", "aab abab bbabab", "abab" * 80):
            words = P._WORD.findall(P.MARK + text.replace(" ", P.MARK))
            assert P.merged(toy, words)[0].tolist() == library.encode(text)


def test_segments_begin_where_words_begin():
    text = P.MARK + P.MARK.join(["ab", "", "c", "", "", "longer"] * 50)
    parts = list(P.segments(text, 7))
    assert "".join(parts) == text and len(parts) > 20
    assert [w for p in parts for w in P._WORD.findall(p)] == P._WORD.findall(text)


def test_decodes_any_ids_as_the_library(spark):
    rng = random.Random(8)
    rows = [[2], [], [1, 2], [0], [1, 0, 5], [259, 259], [300, 2, 300], [31000, 200, 201, 131, 300], [3 + 0xE6, 3 + 0x97, 300], [3 + 0x20, 300]]
    rows += [[rng.choice([rng.randrange(32000), rng.randrange(3, 259)]) for _ in range(rng.randint(1, 30))] for _ in range(200)]
    df = spark.createDataFrame([(k, r) for k, r in enumerate(rows)] + [(None, None)], "k bigint, ids array<int>")
    got = {r["k"]: r["decoded"] for r in P.decode(df, PATH).collect()}
    assert got == {**{k: ORACLE.decode(r) for k, r in enumerate(rows)}, None: ""}


def test_rows_of_a_table(spark, monkeypatch):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD)] + [(3, ODD[3], None), (None, None, None)], "doc_id bigint, text string, ids string").repartition(3)
    got = sorted(((r["doc_id"], list(r["ids"])) for r in P.encode(df, PATH).collect()), key=str)
    assert got == sorted([(i, ORACLE.encode(t, add_eos=True)) for i, t in enumerate(ODD)] + [(3, ORACLE.encode(ODD[3], add_eos=True)), (None, [2])], key=str)
    assert P.decode(P.encode(df.limit(0), PATH), PATH).count() == 0


def test_words_are_forgotten_beyond_the_bound(monkeypatch):
    monkeypatch.setattr(P, "KNOWN", 5)
    store = P._Store(MODEL)
    for k in range(30):
        text = f"{P.MARK}word{k}{P.MARK}other{k}"
        assert np.concatenate(store.ids(text)).tolist() == ORACLE.encode(text[1:].replace(P.MARK, " "))
    assert len(store.known) <= 5 + 2


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_registered_query_over_a_table(spark):
    got = {r["doc_id"]: r for r in P.op12_sentencepiece(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = ORACLE.encode(d["text"] or "", add_eos=True)
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(ORACLE.decode(ids).encode()).hexdigest()


def test_forgotten_words_are_freed_at_once():
    """The words of a store were part of a cycle, and stayed until Python looked for cycles."""
    store = P._Store(MODEL)
    gc.disable()
    try:
        count = sum(type(x) is defaultdict for x in gc.get_objects())
        for k in range(20):
            store.ids(f"{P.MARK}word{k}")
            store.clear()
        assert sum(type(x) is defaultdict for x in gc.get_objects()) == count
    finally:
        gc.enable()


def test_rounds_look_up_new_pairs_only(monkeypatch):
    """Each round looked up every pair of every word."""
    looked = []
    ranks = P._pair_ranks
    monkeypatch.setattr(P, "_pair_ranks", lambda model, left, right: looked.append(len(left)) or ranks(model, left, right))
    words = [f"{P.MARK}{w}" for w in "understanding misrepresentations internationalization the a zqxj".split()] * 5
    sym = np.concatenate([MODEL.char[[ord(c) for c in w]] for w in words])
    ids, word = P.merge_rounds(MODEL, sym, np.repeat(np.arange(len(words)), [len(w) for w in words]))
    assert [ids[word == k].tolist() for k in range(len(words))] == [ORACLE.encode(w[1:]) for w in words]
    merges = len(sym) - len(ids)
    assert sum(looked) <= len(sym) + 2 * merges


def test_a_slice_longer_than_a_segment(monkeypatch):
    monkeypatch.setattr(P, "SEGMENT", 40)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
    texts = ["one two three", None, "", "four " * 30, "five", " "]
    for some in (texts, texts[:3], texts[1:3]):
        got = list(P._encode(PATH, schema)(iter([pa.RecordBatch.from_pydict({"doc_id": list(range(len(some))), "text": pa.array(some, pa.string())})])))
        assert [r["ids"] for b in got for r in b.to_pylist()] == [ORACLE.encode(t or "", add_eos=True) for t in some]

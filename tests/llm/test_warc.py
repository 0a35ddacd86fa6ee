import base64
import gzip
import hashlib
import random

import pytest

from monthgrid.llm import warc as A


def frame(spark, rows):
    return spark.createDataFrame([(*r, "z") for r in rows], "page_id bigint, url string, html string, digest string").repartition(3)


ROWS = [(i, f"http://{'www.' if i % 3 else ''}h{i % 7}.example.org/{i % 40}?q={i}", f"<p>é {i % 25}</p>") for i in range(300)]
ROWS += [(300, None, None), (301, "http://a.b/", ""), (302, "no url\nat all", "<p>é 1</p>"), (None, "http://a.b/x", "alone"), (303, "http://a.b/x", "x" * 300000), (304, "HTTP://U:P@A.B:80/x#f", "y")]


def test_archives_hold_every_page_and_name_the_largest_equal_one(spark):
    captures = A.write_archives(frame(spark, ROWS))
    parts = A.build_index(captures, lines=7)
    got = {r.page_id: r for r in A.read_records(A.lookup(captures.select("key"), parts)).collect()}
    top = {}
    for i, _, h in ROWS:
        top[h or ""] = max(top.get(h or "", -1), -1 if i is None else i)
    assert len(got) == len(ROWS)
    for i, _, h in ROWS:
        data = (h or "").encode()
        r = got[i]
        assert (r.payload_bytes, r.payload_digest) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
        first = i is None or top[h or ""] == i
        assert (r.record_type, r.refers_to) == (("response", None) if first else ("revisit", top[h or ""]))
        assert r.payload == (data if first else None)


def test_small_payloads_are_all_responses_below_the_limit(spark):
    captures = A.write_archives(frame(spark, [(1, "http://a/1", "ab"), (2, "http://a/2", "ab"), (3, "http://a/3", "abcdef"), (4, "http://a/4", "abcdef")]), least=3)
    got = {r.page_id: r.record_type for r in A.read_records(captures.select("archive", "offset", "length")).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_lookup_by_binary_search_equals_a_scan(spark):
    rng = random.Random(3)
    captures = A.write_archives(frame(spark, ROWS))
    parts = A.build_index(captures, parts=3, lines=4)
    rows = captures.collect()
    for key in [*{r.key for r in rng.sample(rows, 20)}, "zzz", "", "com,example", "org,example,h1)/0"]:
        want = sorted((r.archive, r.offset, r.length) for r in rows if r.key == key)
        assert sorted(tuple(c[:3]) for c in A.captures_of(key, parts)) == want


def test_one_url_over_many_blocks_and_parts(spark):
    captures = A.write_archives(frame(spark, [(i, "http://same.org/", f"{i}") for i in range(200)]))
    parts = A.build_index(captures, parts=4, lines=5)
    assert A.lookup(captures.select("key"), parts).count() == 200


def test_empty_table_and_damage(spark):
    captures = A.write_archives(frame(spark, []))
    assert captures.count() == 0 and A.build_index(captures) == []
    assert A.lookup(captures.select("key"), []).count() == 0
    data = A.record(1, 0, "http://a/", b"abc", 3, A.payload_digest(b"abc"), None, "2024-01-01T00:00:00Z")
    assert A.parse(gzip.decompress(gzip.compress(data)))["payload"] == b"abc"
    with pytest.raises(ValueError):
        A.parse(data.replace(b"abc", b"abd"))


def test_keys():
    assert A.surt("https://Blog.example.com:443/a?b#c") == "com,example,blog)/a?b"
    assert A.surt(None) == "-" and A.surt("http://a.b") == "b,a)/" and "\n" not in A.surt("a\n b")

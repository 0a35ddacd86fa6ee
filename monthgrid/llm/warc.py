"""WARC archives of pages and a two-level capture index.

Writing: equal payloads (by SHA-1) are stored once; the row with the largest id holds the payload, the others become revisit
records that name it. A task forwards the html of the largest of its equal payloads only, so a payload that makes up a third of
all rows is shuffled once per task. Each task writes gzip members to a file of its own in the shared folder; the rows it returns
name the file, so files of failed or repeated attempts are never read.

Index: captures are range-partitioned and sorted by reversed-host key and written as gzip blocks of ``BLOCK_LINES`` lines. Each
index part has a sparse directory of its blocks (first key, offset, length). The list of parts (first and last key, two paths)
is the only thing the driver sees; it has one row per index part, a number set by the caller, whatever the corpus. A lookup
bisects the parts, then the part's directory, reads the block's byte range, and finally the record's byte range in the archive.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthgrid.session import new_path, stage

BLOCK_LINES = 3000
#: An archive file is closed beyond this size and the task goes on with the next.
ARCHIVE_BYTES = 1 << 30
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEVEL = 6


def surt(url: str | None) -> str:
    """Reversed-host key of a URL: scheme, user, port 80 or 443 and fragment go, the host is lower-cased and turned round.

    ``https://Blog.example.com:443/a?b#c`` gives ``com,example,blog)/a?b``. No URL gives ``-``. White space and control
    characters are percent-encoded, so that a key is one field of a line.
    """
    if not url:
        return "-"
    m = re.match(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)([^#]*)", url, re.S)
    host, rest = m.groups() if m else ("", url.partition("#")[0])
    host = re.sub(r":(80|443)?$", "", host.rpartition("@")[2].lower())
    key = ",".join(reversed(host.split("."))) + ")" + (rest if rest.startswith("/") or not m else "/" + rest)
    return re.sub(r"[\x00-\x20\x7f\s]", lambda c: quote(c[0]), key)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, row: int, url: str | None, payload: bytes | None, size: int, digest: str, refers: tuple | None, date: str) -> bytes:
    """One WARC record: a response with its payload, or a revisit that repeats the HTTP header only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http + (payload or b"" if refers is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}:{row}>",
            f"WARC-Date: {date}", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f\s]", lambda c: quote(c[0]), url))
    if refers is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{'' if refers[0] is None else refers[0]}:{refers[1]}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """What a record holds; a response's digest is computed from its payload and must equal the one in its header."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda name: (lambda s: int(s) if s else None)(re.match(r"<urn:page:(-?\d*):", fields[name])[1])
    return {"page_id": number("WARC-Record-ID"), "payload_bytes": size, "payload_digest": digest, "record_type": kind,
            "refers_to": number("WARC-Refers-To") if kind == "revisit" else None, "payload": payload if kind == "response" else None}


class _Files:
    """Files of one task in a folder that all executors share, by its URI."""

    def __init__(self, folder: str, name: str):
        self.fs, self.folder = fs.FileSystem.from_uri(folder)
        self.fs.create_dir(self.folder, recursive=True)
        self.uri, self.name, self.out, self.at = folder, name, None, 0

    def write(self, data: bytes) -> tuple[str, int]:
        """Appends and returns the file's URI and the offset written to."""
        if self.out is None or self.at > ARCHIVE_BYTES:
            self.close()
            name = f"{uuid.uuid4().hex}-{self.name}"
            self.path, self.at = f"{self.uri}/{name}", 0
            self.out = self.fs.open_output_stream(f"{self.folder}/{name}", compression=None)
        begin = self.at
        self.out.write(data)
        self.at += len(data)
        return self.path, begin

    def close(self):
        if self.out is not None:
            self.out.close()
            self.out = None


@lru_cache(maxsize=4)
def _open(uri: str):
    where, path = fs.FileSystem.from_uri(uri)
    return where.open_input_file(path)


def _range(uri: str, offset: int, length: int) -> bytes:
    return _open(uri).read_at(length, offset)


def _prepare(least: int):
    """Adds size and digest; of equal payloads in a batch only the largest id keeps its html."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, rows = b.column("page_id").to_pylist(), b.column("row").to_pylist()
            pages = [x or b"" for x in b.column("html").cast(pa.binary()).to_pylist()]
            digests = [payload_digest(p) for p in pages]
            best: dict[str, tuple] = {}
            for i, r, d in zip(ids, rows, digests):
                best[d] = max(best.get(d, ((False, 0), -1)), ((i is not None, i or 0), r))
            kept = [p if len(p) < least or best[d][1] == r else None for p, d, r in zip(pages, digests, rows)]
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("page_id"), b.column("url"), pa.array(kept, pa.binary()),
                                              pa.array([len(p) for p in pages]), pa.array(digests)],
                                             names=["row", "page_id", "url", "payload", "size", "digest"])
    return run


def _write(folder: str, date: str, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(folder, "pages.warc.gz")
        for b in batches:
            out = []
            for r in b.to_pylist():
                again = r["size"] >= least and r["row"] != r["first_row"]
                data = gzip.compress(record(r["page_id"], r["row"], r["url"], r["payload"], r["size"], r["digest"],
                                            (r["first_id"], r["first_row"]) if again else None, date), LEVEL, mtime=0)
                path, begin = files.write(data)
                out.append((surt(r["url"]), path, begin, len(data), r["url"]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()))]
                                             if out else [pa.array([], t) for t in (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())],
                                             names=["key", "archive", "offset", "length", "url"])
        files.close()
    return run


def write_archives(pages: DataFrame, date: str = "2024-01-01T00:00:00Z", least: int = 0) -> DataFrame:
    """Writes a record per row of ``pages`` (page_id, url, html); returns its captures (key, archive, offset, length, url).

    Null html is an empty payload; payloads of fewer than ``least`` bytes are never revisits. Of rows with equal payload and
    equal id, one is the response. Null ids count as smallest, null urls are filed under the key ``-``. Other columns are not read.
    """
    folder = new_path(pages.sparkSession, "warc")
    read = (pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
            .withColumn("row", F.monotonically_increasing_id()))
    rows = stage(read.select("page_id", "url", "html", "row").mapInArrow(
        _prepare(least), "row bigint, page_id bigint, url string, payload binary, size bigint, digest string"), "payloads")
    first = (rows.groupBy("digest").agg(F.max(F.struct("page_id", "row")).alias("first"))
             .select("digest", F.col("first.page_id").alias("first_id"), F.col("first.row").alias("first_row")))
    return stage(rows.join(first, "digest").mapInArrow(
        _write(folder, date, least), "key string, archive string, offset bigint, length bigint, url string"), "captures")


def _index(folder: str, lines: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, directory = _Files(folder, "captures.cdx.gz"), _Files(folder, "blocks.idx")
        held, firsts, low, high, n = [], [], None, None, 0

        def flush():
            path, begin = blocks.write(data := gzip.compress("".join(line for _, line in held).encode(), LEVEL, mtime=0))
            firsts.append((held[0][0], path, begin, len(data)))
            held.clear()

        for b in batches:
            for r in b.to_pylist():
                low = r["key"] if low is None else low
                high, n = r["key"], n + 1
                held.append((r["key"], f"{r['key']} {json.dumps([r['archive'], r['offset'], r['length'], r['url']])}\n"))
                if len(held) == lines:
                    flush()
        if held:
            flush()
        blocks.close()
        if n:
            path, _ = directory.write(json.dumps(firsts).encode())
            directory.close()
            yield pa.RecordBatch.from_arrays([pa.array([low]), pa.array([high]), pa.array([path]), pa.array([directory.at]), pa.array([n])],
                                             names=["low", "high", "directory", "bytes", "n"])
    return run


def build_index(captures: DataFrame, parts: int | None = None, lines: int = BLOCK_LINES) -> list[dict]:
    """Writes sorted blocks and directories; returns the list of parts in key order, at most ``parts`` rows.

    Captures with equal keys may fill several blocks and parts: they are sorted by archive and offset too, so even one URL that
    holds a third of all captures is spread out. No captures give no parts.
    """
    spark = captures.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = ["key", "archive", "offset"]
    written = stage(captures.repartitionByRange(parts, *by).sortWithinPartitions(*by).mapInArrow(
        _index(new_path(spark, "index"), lines), "low string, high string, directory string, bytes bigint, n bigint"), "index-parts")
    return sorted((r.asDict() for r in written.collect()), key=lambda r: (r["low"], r["high"]))


@lru_cache(maxsize=8)
def _directory(path: str, size: int) -> tuple[list[str], list]:
    rows = json.loads(_range(path, 0, size))
    return [r[0] for r in rows], rows


@lru_cache(maxsize=8)
def _block(path: str, offset: int, length: int) -> list[tuple[str, str]]:
    lines = gzip.decompress(_range(path, offset, length)).decode().split("\n")[:-1]
    return [(line.partition(" ")[0], line) for line in lines]


def captures_of(key: str, parts: list[dict]) -> Iterator[tuple[str, int, int, str]]:
    """(archive, offset, length, url) of every capture with this key, by binary search in the parts, a directory and blocks."""
    i = bisect.bisect_left(parts, key, key=lambda p: p["high"])
    while i < len(parts) and parts[i]["low"] <= key:
        firsts, rows = _directory(parts[i]["directory"], parts[i]["bytes"])
        j = max(0, bisect.bisect_left(firsts, key) - 1)
        while j < len(rows) and rows[j][0] <= key:
            lines = _block(*rows[j][1:])
            k = bisect.bisect_left(lines, (key,))
            while k < len(lines) and lines[k][0] == key:
                yield tuple(json.loads(lines[k][1].partition(" ")[2]))
                k += 1
            j += 1
        i += 1


def lookup(keys: DataFrame, parts: list[dict]) -> DataFrame:
    """(key, archive, offset, length) of every capture of the distinct ``key`` values; sorted first, so that each block is read by one task."""
    spark = keys.sparkSession
    known = spark.sparkContext.broadcast(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for key in b.column("key").to_pylist():
                for archive, offset, length, _ in captures_of(key, known.value):
                    found.append((key, archive, offset, length))
                    if len(found) == 10000:
                        yield _rows(found)
                        found = []
            if found:
                yield _rows(found)

    def _rows(found):
        return pa.RecordBatch.from_pylist([dict(zip(("key", "archive", "offset", "length"), f)) for f in found],
                                          pa.schema([("key", pa.string()), ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]))

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (keys.select("key").filter("key IS NOT NULL").distinct().repartitionByRange(n, "key").sortWithinPartitions("key")
            .mapInArrow(run, "key string, archive string, offset bigint, length bigint"))


def read_records(located: DataFrame) -> DataFrame:
    """The records at (archive, offset, length), read by byte range in file order."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 500):
                part = b.slice(i, 500)
                yield pa.RecordBatch.from_pylist([parse(gzip.decompress(_range(*at))) for at in
                                                  zip(*(part.column(c).to_pylist() for c in ("archive", "offset", "length")))], schema)

    n = int(located.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (located.repartitionByRange(n, "archive", "offset").sortWithinPartitions("archive", "offset").mapInArrow(
        run, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"))


def op8_warc(spark, sf_dir) -> DataFrame:
    captures = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    parts = build_index(captures)
    return read_records(lookup(captures.select("key"), parts)).drop("payload")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha1(h) AS x, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
           (CAST('0x' || substr(x, CAST(1 + 5 * (i // 4) AS INT), 5) AS INT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT), 1)), '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to
FROM d
"""

"""Words of many texts at once: byte spans, 64-bit hashes and n-gram hashes, as numpy arrays.

Every separator used here is an ASCII byte, so words of UTF-8 text can be cut without decoding it. Memory is a small
multiple of the batch handed in; ``batches`` keeps that near a megabyte unless a single text is longer.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U = np.uint64
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[list(SPACES)] = False
#: Letters a-z, digits and every byte of a non-ASCII character; meant for lower-cased text.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_rng = np.random.default_rng(20240531)
_BYTE = _rng.integers(0, 2**64, 256, dtype=U)
_PLACE = _rng.integers(0, 2**64, 64, dtype=U) | U(1)
_K = U(0x9E3779B97F4A7C15)
_K_INV = U(pow(int(_K), -1, 2**64))
_CHUNK = 1 << 18


class Words(NamedTuple):
    """Words in text order: byte spans in ``data``, hashes, and ``first``: the index of each text's first word, and the total."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    def owner(self) -> np.ndarray:
        """The number of the text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every output bit depends on every input bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    known = _powers.__dict__.get("known")
    if known is None or len(known[0]) < n:
        out = []
        for base in (_K, _K_INV):
            p = np.full(n, base, U)
            p[0] = 1
            out.append(np.cumprod(p))
        known = _powers.known = tuple(out)
    return known


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte span (spans in order, not overlapping); worked off in chunks of a bounded number of bytes."""
    out = np.empty(len(start), U)
    i = 0
    while i < len(start):
        at = start[i]
        j = max(i + 1, int(np.searchsorted(end, at + _CHUNK, "right")))
        stop = end[j - 1]
        power, inverse = _powers(max(_CHUNK, int(stop - at)) + 1)
        total = np.zeros(stop - at + 1, U)
        np.cumsum(_BYTE[data[at:stop]] * power[: stop - at], out=total[1:])
        s, e = start[i:j] - at, end[i:j] - at
        out[i:j] = (total[e] - total[s]) * inverse[s]
        i = j
    return mix(out)


def split(texts: list[bytes], inside: np.ndarray = NOT_SPACE, lower: bool = False) -> Words:
    """Words (longest runs of ``inside`` bytes) of each text; \\n must be outside."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    if lower:
        data = LOWER[data]
    flag = inside[data]
    edge = np.flatnonzero(flag[1:] != flag[:-1]) + 1
    if len(flag) and flag[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[::2], edge[1::2]
    offset = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offset[1:])
    first = np.searchsorted(start, offset)
    return Words(data, start, end, hash_spans(data, start, end), first)


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on, as far as n words are left; the caller drops those that leave a text."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, U)
    out = h[:m] * _PLACE[0]
    for j in range(1, n):
        out += h[j:m + j] * _PLACE[j]
    return mix(out + U(n))


def within(words: Words, n: int) -> np.ndarray:
    """For each n-gram position: does it stay inside its text?"""
    m = max(0, len(words.hash) - n + 1)
    return np.arange(n, m + n) <= np.repeat(words.first[1:], np.diff(words.first))[:m]


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of a string column; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary() if not pa.types.is_large_string(column.type) else pa.large_binary()).to_pylist()]


def batches(texts: list[bytes], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes, at least a row each."""
    i, size = 0, 0
    for j, t in enumerate(texts):
        if j > i and size + len(t) > limit:
            yield i, j
            i, size = j, 0
        size += len(t) + 1
    if i < len(texts):
        yield i, len(texts)


def give_back() -> None:
    """Returns freed memory to the system: idle Python workers of one stage live on beside the next stage's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not glibc
        pass


def parts(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in slices of few rows, so that no whole batch of texts is held as Python objects."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)

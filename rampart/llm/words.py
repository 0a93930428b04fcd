"""Words of whole texts as numpy arrays, straight from Arrow string buffers.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]`` of the UTF-8 text.  All
operators of this package that look at words share this module: it finds the
words of many texts at once and gives each a 64-bit hash that is the same in
every process, so hashes may be shuffled, stored and joined.

Memory is bounded: a batch is worked on in slices of about ``CHUNK`` bytes; one
longer text is a slice of its own, and its words are hashed block by block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 2 << 20
_BLOCK = 1 << 20
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: spreads every input bit over the word."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POW = _powers(_BASE, 2 * _BLOCK)
_INV = _powers(_INVERSE, 2 * _BLOCK)


@dataclass
class Words:
    """Words of the texts of one slice; row r owns words first[r]:first[r+1]."""
    data: np.ndarray      # uint8, the texts one after another (lower-cased if asked for)
    rows: np.ndarray      # int64, byte offsets of the texts in data, len = texts + 1
    start: np.ndarray     # int64, first byte of each word
    end: np.ndarray       # int64, one past the last byte
    first: np.ndarray     # int64, len = texts + 1

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word, by prefix sums of byte codes times powers."""
        out = np.empty(len(self), U64)
        i, n = 0, len(self)
        while i < n:
            s0 = self.start[i]
            j = max(i + 1, int(np.searchsorted(self.end, s0 + _BLOCK, "right")))
            out[i:j] = self._hash(i, j, s0)
            i = j
        return out

    def _hash(self, i: int, j: int, s0: int) -> np.ndarray:
        b = self.data[s0:self.end[j - 1]]
        if len(b) < len(_POW):
            pw, iv = _POW, _INV
        else:
            pw, iv = _powers(_BASE, len(b) + 1), _powers(_INVERSE, len(b) + 1)
        acc = np.zeros(len(b) + 1, U64)
        np.cumsum(_BYTE[b] * pw[:len(b)], out=acc[1:])
        s, e = self.start[i:j] - s0, self.end[i:j] - s0
        return mix((acc[e] - acc[s]) * iv[s] + (e - s).astype(U64) * U64(0xD6E8FEB86659FD93))


def words_of(texts: pa.Array, lower: bool = False) -> Words:
    """The words of an Arrow string array; a null text has none."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if n == 0:
        z = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint8), np.zeros(1, np.int64), z, z, np.zeros(1, np.int64))
    _, offs, buf = texts.buffers()
    rows = np.frombuffer(offs, np.int64)[texts.offset:texts.offset + n + 1]
    data = (np.frombuffer(buf, np.uint8)[rows[0]:rows[-1]] if buf is not None
            else np.zeros(0, np.uint8))
    rows = rows - rows[0]
    solid = ~_SPACE[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = solid
    before[rows] = False                       # a text begins: no word goes on
    start = np.flatnonzero(solid & ~before[:-1])
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = solid
    after[rows] = False
    end = np.flatnonzero(solid & ~after[1:]) + 1
    if lower:
        data = _LOWER[data]
    return Words(data, rows, start, end, np.searchsorted(start, rows))


def slices(batch: pa.RecordBatch, column: str = "text",
           limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of a slice hold about ``limit`` bytes."""
    col = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string())
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1] \
        if len(col) else np.zeros(1, np.int64)
    i = 0
    while i < len(col):
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield batch.slice(i, j - i)
        i = j


def segments(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For runs of ``size`` words within one text: index of the first word of
    each run, and its row."""
    per = np.maximum(w.counts - size + 1, 0)
    row = np.repeat(np.arange(len(per)), per)
    base = np.repeat(w.first[:-1] - np.concatenate([[0], np.cumsum(per)[:-1]]), per)
    return np.arange(len(row)) + base, row


class Rolling:
    """Hashes of runs of words, by prefix sums over the word hashes of a slice."""

    def __init__(self, h: np.ndarray, salt: int = 0):
        n = len(h) + 1
        if n <= len(_POW):
            self.pw, self.iv = _POW, _INV
        else:
            self.pw, self.iv = _powers(_BASE, n), _powers(_INVERSE, n)
        self.acc = np.zeros(n, U64)
        if salt:
            h = mix(h ^ U64(salt))
        np.cumsum(h * self.pw[:len(h)], out=self.acc[1:])

    def of(self, start: np.ndarray, size) -> np.ndarray:
        return mix((self.acc[start + size] - self.acc[start]) * self.iv[start]
                   + np.asarray(size).astype(U64) * U64(0xA0761D6478BD642F))

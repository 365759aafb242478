"""Vectorised word handling over the UTF-8 bytes of Arrow string columns.

Whole batches are tokenised at once: one byte table says which bytes belong to
words, word and shingle fingerprints are 64-bit. Slices of a batch keep the
temporary arrays near ``SLICE_BYTES`` however long the batch is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

SLICE_BYTES = 1 << 20
LONG_WORD = 32
_U = np.uint64
_M1, _M2, _GOLD = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB), _U(0x9E3779B97F4A7C15)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Words split at space, tab, line feed, vertical tab, form feed, carriage return.
SPACED = np.ones(256, bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: Words of digits, lower-case a-z and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> _U(30))
    x = x * _M1
    x ^= x >> _U(27)
    x *= _M2
    x ^= x >> _U(31)
    return x


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, n + 1 offsets into them and validity of a string column; null is zero bytes long."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    n = len(col)
    _, off, data = col.buffers()
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(0, bool)
    offsets = np.frombuffer(off, np.int64)[col.offset:col.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    valid = np.ones(n, bool) if col.null_count == 0 else np.asarray(col.is_valid())
    if col.null_count and np.any(np.diff(offsets)[~valid]):
        return utf8(col.fill_null(""))[:2] + (valid,)
    return raw, offsets, valid


def slices(offsets: np.ndarray, budget: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``budget`` bytes, or of one longer row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + budget, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi
        lo = hi


class Words:
    """Words of the rows lo to hi of a batch: byte ranges in ``text``, row numbers from 0."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lo: int, hi: int,
                 table: np.ndarray, lower: bool = True):
        base = int(offsets[lo])
        raw = data[base:int(offsets[hi])]
        self.raw = raw
        self.text = LOWER[raw] if lower else raw
        self.rows = hi - lo
        self.bounds = (offsets[lo:hi + 1] - base).astype(np.int64)
        n = len(raw)
        inside = table[self.text]
        edge = np.zeros(n + 1, bool)
        edge[self.bounds] = True
        first = inside.copy()
        first[1:] &= ~inside[:-1] | edge[1:n]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | edge[1:n]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.row = np.searchsorted(self.bounds, self.start, "right") - 1
        self.count = np.bincount(self.row, minlength=self.rows) if n else np.zeros(self.rows, np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.count)])

    def hashes(self) -> np.ndarray:
        """A 64-bit fingerprint of each word."""
        if not len(self.start):
            return np.zeros(0, _U)
        padded = np.zeros(len(self.text) + LONG_WORD + 8, np.uint8)
        padded[:len(self.text)] = self.text
        eight = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))
        length = self.end - self.start
        h = mix(length.astype(_U) * _GOLD + _U(1))
        for at in range(0, min(LONG_WORD, int(length.max())), 8):
            idx = np.flatnonzero(length > at) if at else slice(None)
            left = np.minimum(length[idx] - at, 8).astype(_U)
            part = eight[self.start[idx] + at]
            part &= ~_U(0) >> ((_U(8) - left) * _U(8))
            h[idx] = mix((h[idx] ^ part) * _GOLD + _U(at + 7))
        for i in np.flatnonzero(length > LONG_WORD):
            h[i] = xxhash.xxh64_intdigest(self.text[self.start[i]:self.end[i]].tobytes())
        return h

    def windows(self, h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and fingerprint of each run of ``size`` words inside one row."""
        m = len(h) - size + 1
        if m <= 0:
            return np.zeros(0, np.int64), np.zeros(0, _U)
        at = np.flatnonzero(self.row[:m] == self.row[size - 1:]) if size > 1 else np.arange(m)
        out = np.full(len(at), _U(size), _U)
        for j in range(size):
            out *= _GOLD
            out += h[at + j]
            out ^= out >> _U(32)
        return at, mix(out)

    def shingles(self, h: np.ndarray, size: int) -> list[np.ndarray]:
        """Distinct fingerprints of each row, sorted; a shorter row is one shingle."""
        at, w = self.windows(h, size)
        cut = np.searchsorted(self.row[at], np.arange(self.rows + 1)) if len(at) else np.zeros(self.rows + 1, int)
        out = [np.unique(w[a:b]) for a, b in zip(cut[:-1], cut[1:])]
        for r in np.flatnonzero((self.count > 0) & (self.count < size)):
            a, b = self.first[r], self.first[r + 1]
            out[r] = np.array([xxhash.xxh64_intdigest(h[a:b].tobytes(), seed=int(b - a))], _U)
        return out


def word_ranges(text: str, spans: list[tuple[int, int]]) -> str:
    """The text of word ranges [lo, hi) (words split at white space), each with its own inner spacing."""
    data = np.frombuffer(text.encode(), np.uint8)
    w = Words(data, np.array([0, len(data)]), 0, 1, SPACED, lower=False)
    return "\n".join(data[w.start[a]:w.end[b - 1]].tobytes().decode() for a, b in spans if b > a)

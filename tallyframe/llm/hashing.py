"""Words of Arrow text columns as 64-bit hashes, found and hashed with whole-array numpy.

A word is a maximal run of bytes that a 256-entry table maps to a non-zero value; the value
also folds case.  Texts are worked on whole, in pieces of bounded size cut between words, so
the memory needed does not follow the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text hashed at a time, and bytes of text per slice of a batch.
PIECE = 1 << 20
SLICE = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64


def byte_table(words: str) -> np.ndarray:
    """``space``: words are runs of anything but ASCII white space; ``alnum``: runs of ASCII
    letters, digits and all bytes over 127.  A-Z fold to a-z in both."""
    t = np.arange(1, 257, dtype=np.uint64)
    if words == "space":
        t[[0x20, *range(0x09, 0x0E)]] = 0
    else:
        keep = np.zeros(256, bool)
        for lo, hi in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
            keep[lo:hi] = True
        t[~keep] = 0
    t[0x41:0x5B] = t[0x61:0x7B]
    return t


def mix64(x: np.ndarray) -> np.ndarray:
    """Splitmix finaliser."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


class _Powers:
    def __init__(self):
        self.up = self.down = np.ones(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            base = np.full(n, _BASE, np.uint64)
            base[0] = 1
            self.up = np.cumprod(base)
            base[1:] = pow(_BASE, -1, 1 << 64)
            self.down = np.cumprod(base)
        return self.up, self.down


_POWERS = _Powers()


def _spans(data: np.ndarray, table: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of each word; a text's bounds also end words."""
    inside = table[data] != 0
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    starts[cut] = inside[cut]
    ends[cut - 1] = inside[cut - 1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def _pieces(data: np.ndarray, start: np.ndarray, end: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of more than ``longest`` bytes as pieces of about that size, cut between characters."""
    n = -(-(end - start) // longest)
    if not len(n) or n.max() == 1:
        return start, end
    word = np.repeat(np.arange(len(n)), n)
    part = np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n)
    begin, limit = start[word] + part * longest, end[word]
    for _ in range(3):  # a character's bytes after the first
        begin += (part > 0) & (begin < limit) & (data[np.minimum(begin, len(data) - 1)] & 0xC0 == 0x80)
    word, begin, limit = (x[begin < limit] for x in (word, begin, limit))
    last = np.append(word[1:] != word[:-1], True)
    return begin, np.where(last, limit, np.append(begin[1:], 0))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes; spans are ascending, and bytes between them hash to 0."""
    out, lo = np.empty(len(start), np.uint64), 0
    while lo < len(start):  # pieces of whole spans
        hi = max(lo + 1, int(np.searchsorted(end, start[lo] + PIECE, side="right")))
        a, b = int(start[lo]), int(end[hi - 1])
        up, down = _POWERS.get(max(PIECE, b - a))
        at = start[lo:hi] - a
        total = np.add.reduceat(table[data[a:b]] * up[:b - a], at)
        out[lo:hi] = mix64(total * down[at] + (end - start)[lo:hi].astype(np.uint64))
        lo = hi
    return out


class Words:
    """The words of a run of texts: ``hash``, ``start`` and ``end`` (bytes in ``data``) by word;
    text i has words ``first[i]`` to ``first[i + 1]`` and begins at byte ``offsets[i]``.
    ``longest``: longer words are cut into pieces of about so many bytes, each a word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray, longest: int | None = None):
        self.data, self.offsets = data, offsets
        self.start, self.end = _spans(data, table, offsets) if len(data) else (np.zeros(0, np.int64),) * 2
        if longest:
            self.start, self.end = _pieces(data, self.start, self.end, longest)
        self.first = np.searchsorted(self.start, offsets)
        self.hash = span_hashes(data, self.start, self.end, table)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words from each word on, and whether they lie in one text."""
        n = len(self.hash)
        if n < k:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        out = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            out = out * _U(0xD6E8FEB86659FD93) + self.hash[j:n - k + 1 + j]
        last = np.repeat(self.first[1:], np.diff(self.first))  # end of each word's text
        return mix64(out), np.arange(n - k + 1) + k <= last[:n - k + 1]


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; null texts are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, size: int | None = None) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds at most ``size`` (SLICE) bytes of text, or one row."""
    size = size or SLICE
    if not batch.num_rows:
        return
    _, offsets = texts(batch.column(column))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi

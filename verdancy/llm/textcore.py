"""Vectorised word and window hashing over Arrow string buffers.

A *word* is a maximal run of bytes other than ASCII white space (0x20 and
0x09-0x0D), which in UTF-8 is the same as the pattern ``[^\\x20\\x09-\\x0D]+``
over code points.  All routines work on whole texts; a batch is only cut
between documents (see :func:`slices`) so that temporary arrays stay small.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_SEP = np.zeros(256, dtype=bool)
_SEP[[0x20, *range(0x09, 0x0E)]] = True

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INV = pow(_BASE, -1, 1 << 64)


def _byte_table(seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(1, 1 << 63, 256, dtype=np.uint64)


_TABLES = [_byte_table(20240601), _byte_table(20240602)]
_POWERS: dict[int, np.ndarray] = {}
#: Powers that a worker keeps between calls, 32 MB a base; longer runs are worked out when met.
KEPT_POWERS = 1 << 22


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(1, -(-n // (1 << 20))) << 20, base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if len(have) <= KEPT_POWERS:
            _POWERS[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def strings(column: pa.Array) -> pa.Array:
    """A contiguous large_string array in which null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    return column.fill_null("") if column.null_count else column


def slices(texts: pa.Array, max_bytes: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """(first, end) row ranges of about max_bytes of text each; a longer document is alone in its range."""
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=n + 1, offset=texts.offset * 8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + max_bytes, side="right")) - 1
        end = min(n, max(first + 1, end))
        yield first, end
        first = end


@dataclass
class Words:
    """Words of a run of documents, in order. start and end are byte offsets into data."""

    data: np.ndarray
    doc_byte: np.ndarray  # n_docs + 1 byte offsets into data
    start: np.ndarray
    end: np.ndarray
    doc_word: np.ndarray  # n_docs + 1 offsets into start/end

    @property
    def n_docs(self) -> int:
        return len(self.doc_byte) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.doc_word)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), self.counts())


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of the texts and their n + 1 offsets, without a copy."""
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=n + 1, offset=texts.offset * 8)
    buffer = texts.buffers()[2]
    lo, hi = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(buffer, dtype=np.uint8, count=hi - lo, offset=lo) if hi > lo else np.zeros(0, dtype=np.uint8)
    return data, offsets - lo


def words(texts: pa.Array) -> Words:
    """Find the words of a large_string array without nulls."""
    data, offsets = raw(texts)
    inside = ~_SEP[data]
    before = np.empty(len(data) + 1, dtype=bool)
    before[0] = before[-1] = False
    before[1:-1] = inside[:-1]
    cut = offsets[(offsets > 0) & (offsets < len(data))]
    before[cut] = False
    start = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    after[cut - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    return Words(data, offsets, start, end, np.searchsorted(start, offsets))


def word_hashes(w: Words, lane: int = 0, table: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of each word's bytes; another lane is another hash function."""
    n = len(w.data)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((_TABLES[lane] if table is None else table)[w.data] * _powers(_BASE, n), out=sums[1:])
    return mix((sums[w.end] - sums[w.start]) * _powers(_INV, n + 1)[w.start] + (w.end - w.start).astype(np.uint64))


def window_hashes(hashes: np.ndarray, starts: np.ndarray, width: int | np.ndarray) -> np.ndarray:
    """Hashes of the runs of width words that begin at starts."""
    n = len(hashes)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(hashes * _powers(_BASE, n), out=sums[1:])
    return mix((sums[starts + width] - sums[starts]) * _powers(_INV, n + 1)[starts] + np.uint64(0x1234567))


def window_starts(w: Words, width: int) -> np.ndarray:
    """Index of each word that begins a window of width words inside its own document."""
    counts = w.counts()
    free = np.maximum(counts - width + 1, 0)
    total = int(free.sum())
    skip = np.repeat(w.doc_word[:-1] - (np.cumsum(free) - free), free)
    return np.arange(total) + skip

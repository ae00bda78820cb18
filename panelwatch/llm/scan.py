"""Whole texts as byte arrays: words, shingles and rolling hashes for Arrow batches.

Every function works on UTF-8 bytes with numpy, on runs of whole documents of a
bounded number of bytes (a longer document makes a run of its own).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

RUN_BYTES = 1 << 18
SHINGLE = 5

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20240501).integers(1, 2**64, 256, dtype=np.uint64)
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; null is empty."""
    col = batch.column(batch.schema.get_field_index(name))
    if not len(col):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, at, data = col.buffers()
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(offsets: np.ndarray, size: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges (first, past the last) of about ``size`` bytes each."""
    n, first = len(offsets) - 1, 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all 64 bits over all 64 bits."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    return h


class Powers:
    """Powers of the hash base and of its inverse, kept between runs of a task."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, RUN_BYTES + (RUN_BYTES >> 2))
            for name, base in (("up", BASE), ("down", BASE_INVERSE)):
                table = np.full(size, base, np.uint64)
                table[0] = 1
                setattr(self, name, np.cumprod(table, dtype=np.uint64))
        return self.up[:n], self.down[:n]


class Rolling:
    """Polynomial hashes of any slice of one byte run."""

    def __init__(self, data: np.ndarray, powers: Powers) -> None:
        up, self.down = powers.upto(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def grams(self, k: int) -> np.ndarray:
        """The hash of the ``k`` bytes at each position."""
        n = len(self.sums) - k
        return (self.sums[k:] - self.sums[:-k]) * self.down[:n] if n > 0 else np.empty(0, np.uint64)


def word_spans(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the first word of each document (one more at the end).

    ``apart`` tells for each byte value whether it separates words; white space if not given.
    """
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    return spans(apart[data], edge, offsets)


def spans(space: np.ndarray, edge: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words as in ``word_spans``, from the bytes that separate words and the places where a word begins or ends anyway."""
    before = np.ones(len(space), bool)
    before[1:] = space[:-1]
    after = np.ones(len(space), bool)
    after[:-1] = space[1:]
    starts = np.flatnonzero(~space & (before | edge[:-1]))
    ends = np.flatnonzero(~space & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, everything else as it is."""
    return _LOWER[data]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    if not len(starts):
        return np.empty(0, np.uint64)
    return mix(Rolling(data, powers).of(starts, ends) + (ends - starts).astype(np.uint64))


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """The hash of ``k`` consecutive words at each position, whatever document they lie in."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.full(n, k, np.uint64)
    for i in range(k):
        h = h * np.uint64(0xD6E8FEB86659FD93) + words[i : i + n]
    return mix(h)


def inside(firsts: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which of ``n`` word windows of length ``k`` lie within one document."""
    ok = np.ones(n, bool)
    for edge in firsts[1:-1]:
        ok[max(0, edge - k + 1) : edge] = False
    return ok


def shingle_sets(words: np.ndarray, firsts: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all documents, end to end, and their offsets.

    A document of fewer than ``k`` words has its whole sequence as one shingle, one
    without words has none.
    """
    grams = window_hashes(words, k)
    sets, sizes = [], np.zeros(len(firsts), np.int64)
    for i in range(len(firsts) - 1):
        a, b = int(firsts[i]), int(firsts[i + 1])
        if b - a >= k:
            s = np.sort(grams[a : b - k + 1])
            if len(s) > 1:
                keep = np.empty(len(s), bool)
                keep[0] = True
                np.not_equal(s[1:], s[:-1], out=keep[1:])
                s = s[keep]
        elif b > a:
            s = window_hashes(words[a:b], b - a)
        else:
            continue
        sets.append(s)
        sizes[i + 1] = len(s)
    return (np.concatenate(sets) if sets else np.empty(0, np.uint64)), np.cumsum(sizes)

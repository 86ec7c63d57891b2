"""Whole text columns as numpy arrays: words, their hashes and their places, without Python per word.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage
return. Hashes are 64 bits and depend on nothing but the bytes, so that they agree between tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes scanned at once; a longer text is scanned whole, in a chunk of its own.
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_WORD = ~_SPACE

_rng = np.random.default_rng(20_240_501)
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_ROLES = _rng.integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits; one-to-one."""
    x = values.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(0, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            def row(base: int) -> np.ndarray:
                factors = np.full(n, base, dtype=np.uint64)
                factors[0] = 1
                return np.multiply.accumulate(factors)

            up, down = row(_BASE), row(_BASE_INVERSE)
            if n > 4 * CHUNK_BYTES:
                return up, down
            self.up, self.down = up, down
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


@dataclass
class Chunk:
    """Some consecutive rows of a text column; nulls are empty."""

    first_row: int
    data: np.ndarray
    bounds: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.bounds) - 1


@dataclass
class Words:
    """Byte bounds of a chunk's words; `first[i]:first[i + 1]` are the words of row i."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, bounds, data = texts.buffers()
    if data is None:
        data = pa.py_buffer(b"")
    bounds = np.frombuffer(bounds, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8)
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(bounds, bounds[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), len(texts))
        yield Chunk(at, data[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at])
        at = to


def words(chunk: Chunk) -> Words:
    inside = _WORD[chunk.data]
    n = len(inside)
    if n == 0:
        empty = np.zeros(0, dtype=np.int64)
        return Words(empty, empty, np.zeros(chunk.rows + 1, dtype=np.int64))
    edges = chunk.bounds[(chunk.bounds > 0) & (chunk.bounds < n)]
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[edges] = False
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(starts, ends, np.searchsorted(starts, chunk.bounds))


def span_hashes(
    chunk: Chunk, starts: np.ndarray, ends: np.ndarray, lower: bool = False
) -> np.ndarray:
    """A hash of each span of bytes; `lower` reads A-Z as a-z."""
    n = len(chunk.data)
    up, down = _POWERS.get(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[chunk.data] * up[:n], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * down[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * _ROLES[63])


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every `size` consecutive word hashes, also across rows: callers mask those."""
    n = max(0, len(hashes) - size + 1)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        total += hashes[i : i + n] * _ROLES[i]
    return mix(total)


def code_point_counts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """UTF-8 code points in each span."""
    total = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=total[1:])
    return total[ends] - total[starts]

"""Texts cut before white space, and the ids of every distinct span solved once by a worker."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import chain

import numpy as np

from stratalake.llm.textscan import Chunk, span_hashes

_OPENS = np.zeros(256, dtype=bool)
_OPENS[[9, 10, 32]] = True
# Last bytes after which a cut might fall inside white space: ASCII, separators, U+2581.
_ASCII = np.zeros(256, dtype=bool)
_ASCII[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True


def _space_ends(data: np.ndarray) -> np.ndarray:
    """Whether a byte ends a character that some pattern takes for white space."""
    ends = _ASCII[data]
    if len(data) > 1:
        before, last = data[:-1], data[1:]
        ends[1:] |= (before == 0xC2) & ((last == 0x85) | (last == 0xA0))
    if len(data) > 2:
        a, b, c = data[:-2], data[1:-1], data[2:]
        ends[2:] |= (a == 0xE1) & (b == 0x9A) & (c == 0x80)
        ends[2:] |= (a == 0xE2) & (b == 0x80) & ((c < 0x90) | (c >= 0xA8) & (c < 0xB0))
        ends[2:] |= (a == 0xE2) & (((b == 0x81) & (c == 0x9F)) | ((b == 0x96) & (c == 0x81)))
        ends[2:] |= (a == 0xE3) & (b == 0x80) & (c == 0x80)
    return ends


def cut_places(data: np.ndarray) -> np.ndarray:
    """Places before a space, tab or line feed that follows no white space: no pattern of white
    space and no piece of a vocabulary that keeps spaces in front reaches across one."""
    cut = _OPENS[data[1:]] & ~_space_ends(data)[:-1] if len(data) else np.zeros(0, dtype=bool)
    return np.flatnonzero(cut) + 1


def spans(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of a chunk's spans, and the first span of each row."""
    heads = chunk.bounds[:-1][np.diff(chunk.bounds) > 0]
    starts = np.union1d(heads, cut_places(chunk.data))
    ends = np.append(starts[1:], len(chunk.data)) if len(starts) else starts
    return starts, ends, np.searchsorted(starts, chunk.bounds)


class SpanMemo:
    """Ids of spans under one or more encoders, by hash.

    Holds `limit` spans and 16 ids for each of them at most; beyond either it starts anew.
    """

    def __init__(self, encoders: Sequence[Callable[[list[bytes]], list[list[int]]]], limit: int):
        self.encoders, self.limit = encoders, limit
        self._reset()

    def _reset(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.at = [np.zeros(0, dtype=np.int64) for _ in self.encoders]
        self.size = [np.zeros(0, dtype=np.int32) for _ in self.encoders]
        self.ids = [np.zeros(0, dtype=np.int32) for _ in self.encoders]
        self.used = [0 for _ in self.encoders]

    def _learn(self, keys: np.ndarray, place: np.ndarray, texts: list[bytes]) -> None:
        self.keys = np.insert(self.keys, place, keys)
        for i, encode in enumerate(self.encoders):
            found = encode(texts)
            size = np.fromiter(map(len, found), dtype=np.int32, count=len(found))
            used, total = self.used[i], int(size.sum())
            if used + total > len(self.ids[i]):
                grown = np.zeros(used + total + used // 2, dtype=np.int32)
                grown[:used] = self.ids[i][:used]
                self.ids[i] = grown
            self.ids[i][used : used + total] = np.fromiter(chain.from_iterable(found), np.int32, total)
            until = np.cumsum(size, dtype=np.int64)
            self.at[i] = np.insert(self.at[i], place, used + until - size)
            self.size[i] = np.insert(self.size[i], place, size)
            self.used[i] = used + total

    def tokens(self, chunk: Chunk) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each encoder all ids of a chunk and the bounds of its rows."""
        starts, ends, first = spans(chunk)
        if not len(starts):
            empty = np.zeros(0, dtype=np.int32), np.zeros(chunk.rows + 1, dtype=np.int64)
            return [empty for _ in self.encoders]
        keys, example, of_span = np.unique(
            span_hashes(chunk, starts, ends), return_index=True, return_inverse=True
        )
        if len(self.keys) + len(keys) > self.limit or max(self.used) > 16 * self.limit:
            self._reset()
        place = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), dtype=bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == keys[inside]
        if not known.all():
            data, new = chunk.data.tobytes(), example[~known]
            texts = [data[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())]
            self._learn(keys[~known], place[~known], texts)
            place = np.searchsorted(self.keys, keys)
        out = []
        for at, size, ids in zip(self.at, self.size, self.ids):
            own = size[place][of_span]
            until = np.cumsum(own, dtype=np.int64)
            flat = ids[np.repeat(at[place][of_span] - (until - own), own) + np.arange(until[-1])]
            out.append((flat, np.concatenate([[0], until])[first]))
        return out

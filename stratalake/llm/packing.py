"""Best-two-fit packing of tokenized documents into sequences of bounded length.

Documents are tokenized whole and closed by an end id; only documents longer than a sequence are
cut, into full pieces and a shorter last one. Pieces are written once with a number of their own and
dealt into groups of bounded size by a hash of their id, place, contents and number, so that neither
null or repeated ids nor copies of a text fill a group; each group is packed by best-two-fit: a bin takes the longest piece left
and then, again and again, the longest that fits; while a gap remains, the bin's smallest piece is
exchanged for the two pieces left that fill the widened gap most tightly.

Tokenizing: this tokenizer lower-cases, drops white space and never joins letters with punctuation,
so a document has the ids of its units in order: words, cut between plain letters and ASCII
punctuation other than the apostrophe. Every distinct unit is encoded once and then looked up by
its hash, for a whole chunk of text at a time. A chunk in which a special token might be spelt out
is cut at white space only, with its case kept.

Defined cases: a null or empty text is the end id alone. Repeated rows are packed once each. Null
ids are kept as null. Equal pieces are ordered by id, so reruns over the same files place the same
rows alike. An empty table gives no rows. Only the id and text columns are read; clashing names do not matter.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.textscan import Chunk, chunks, span_hashes, words
from stratalake.sources.staging import Staging


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@dataclass(frozen=True)
class PackingParams:
    max_tokens: int = 2048
    end_id: int = 0
    # Pieces that one task packs together, on average.
    group_size: int = 16_384
    # Distinct units remembered by one worker, about 40 bytes each; beyond it the memory starts anew.
    cached_units: int = 500_000


# Classes of bytes: plain letters with the lead byte of U+00C0 to U+00FF, and ASCII punctuation.
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), 0xC3]] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]] = True


def units(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """Starts and ends of a chunk's units, the first unit of each row, and whether case is free."""
    data, found = chunk.data, words(chunk)
    if b"<|" in data.tobytes():
        return found.starts, found.ends, found.first, False
    letter, mark = _LETTER[data], _MARK[data]
    # The second byte of those letters; the signs for times and division are none.
    second = np.flatnonzero(data[:-1] == 0xC3) + 1
    letter[second] = (data[second] != 0x97) & (data[second] != 0xB7)
    cut = np.flatnonzero(letter[:-1] & mark[1:] | mark[:-1] & letter[1:]) + 1
    cut = cut[~np.isin(cut, chunk.bounds, assume_unique=False)]
    # The lead byte of a sign is not a letter either.
    cut = cut[~((data[cut] == 0xC3) & np.isin(data[np.minimum(cut + 1, len(data) - 1)], (0x97, 0xB7)))]
    starts, ends = np.sort(np.concatenate([found.starts, cut])), np.sort(np.concatenate([found.ends, cut]))
    return starts, ends, np.searchsorted(starts, chunk.bounds), True


class UnitTokens:
    """Ids of units, by hash."""

    def __init__(self, path: str, limit: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encoder, self.limit = Tokenizer.from_file(path), limit
        self._reset()

    def _reset(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.at = np.zeros(0, dtype=np.uint32)
        self.size = np.zeros(0, dtype=np.uint32)
        self.ids = np.zeros(0, dtype=np.uint32)
        self.used = 0

    def _learn(self, keys: np.ndarray, place: np.ndarray, texts: list[str]) -> None:
        """`place`: where the sorted new keys belong among the known ones."""
        found = [e.ids for e in self.encoder.encode_batch(texts, add_special_tokens=False)]
        size = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        total = int(size.sum())
        if self.used + total > len(self.ids):
            grown = np.zeros(self.used + total + len(self.ids) // 2, dtype=np.uint32)
            grown[: self.used] = self.ids[: self.used]
            self.ids = grown
        self.ids[self.used : self.used + total] = np.fromiter(chain.from_iterable(found), np.uint32, total)
        self.keys = np.insert(self.keys, place, keys)
        self.at = np.insert(self.at, place, self.used + np.cumsum(size) - size)
        self.size = np.insert(self.size, place, size)
        self.used += total

    def _known(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), dtype=bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == keys[inside]
        return place, known

    def encode(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a chunk and the number of ids of each row."""
        starts, ends, first, lower = units(chunk)
        if not len(starts):
            return np.zeros(0, dtype=np.uint32), np.zeros(chunk.rows, dtype=np.int64)
        hashes = span_hashes(chunk, starts, ends, lower=lower) + np.uint64(lower)
        keys, example, of_unit = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.limit:
            self._reset()
        place, known = self._known(keys)
        if not known.all():
            data, new = chunk.data.tobytes(), example[~known]
            self._learn(keys[~known], place[~known], [
                data[a:b].decode("utf-8", "replace") for a, b in zip(starts[new].tolist(), ends[new].tolist())
            ])
            place, _ = self._known(keys)
        at, size = self.at[place][of_unit].astype(np.int64), self.size[place][of_unit]
        until = np.cumsum(size, dtype=np.int64)
        ids = self.ids[np.repeat(at - (until - size), size) + np.arange(until[-1])]
        before = np.concatenate([[0], until])
        return ids, np.diff(before[first])


_UNIT_TOKENS: dict[tuple[str, int], UnitTokens] = {}


def unit_tokens(path: str, limit: int) -> UnitTokens:
    """One per worker process, kept between tasks."""
    if (path, limit) not in _UNIT_TOKENS:
        _UNIT_TOKENS[path, limit] = UnitTokens(path, limit)
    return _UNIT_TOKENS[path, limit]


def closed_ids(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids with the end id after every row, and the bounds of the rows."""
    bounds = np.concatenate([[0], np.cumsum(counts + 1)])
    out = np.full(int(bounds[-1]), end_id, dtype="<u4")
    out[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
    return out, bounds


def token_pieces(
    docs: DataFrame, tokenizer: str | None = None, params: PackingParams = PackingParams(),
    doc_id: str = "doc_id", text: str = "text", with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and the ids themselves
    (little-endian unsigned 32-bit) on request."""
    path = tokenizer or default_tokenizer()
    fields = [
        T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ] + [T.StructField("ids", T.BinaryType())] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = unit_tokens(path, params.cached_units)
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                ids, bounds = closed_ids(*encoder.encode(chunk), params.end_id)
                sizes = np.diff(bounds)
                pieces = -(-sizes // params.max_tokens)
                row = np.repeat(np.arange(chunk.rows), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * params.max_tokens
                length = np.minimum(sizes[row] - start, params.max_tokens)
                at = bounds[row] + start
                cut = [ids[a : a + n] for a, n in zip(at.tolist(), length.tolist())]
                arrays = [
                    batch.column(0).take(pa.array(row + chunk.first_row)), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                    pa.array([zlib.crc32(x) for x in cut], pa.int64()),
                ] + ([pa.array([x.tobytes() for x in cut], pa.binary())] if with_ids else [])
                yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in fields])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, T.StructType(fields)
    )


def best_two_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of lengths; `lengths` lie between 1 and the capacity."""
    count = np.bincount(lengths, minlength=capacity + 1)
    left = [int(x) for x in np.flatnonzero(count)]
    bins = []

    def take(length: int) -> None:
        count[length] -= 1
        if not count[length]:
            left.pop(bisect_left(left, length))

    def give(length: int) -> None:
        if not count[length]:
            insort(left, length)
        count[length] += 1

    def fill(filled: list[int], gap: int) -> int:
        while gap and left and left[0] <= gap:
            length = left[bisect_right(left, gap) - 1]
            take(length)
            filled.append(length)
            gap -= length
        return gap

    def best_two(room: int, beat: int) -> tuple[int, int] | None:
        """Two lengths left whose sum is the largest in (beat, room]."""
        own = np.flatnonzero(count[: max(0, room)])
        if not len(own):
            return None
        place = np.searchsorted(own, np.minimum(own, room - own), side="right") - 1
        place -= (place >= 0) & (own[place] == own) & (count[own] < 2)
        sums = np.where(place >= 0, own + own[place], 0)
        best = len(sums) - 1 - int(sums[::-1].argmax())
        return (int(own[best]), int(own[place[best]])) if sums[best] > beat else None

    while left:
        first = left[-1]
        take(first)
        filled = [first]
        gap = fill(filled, capacity - first)
        while gap and len(filled) > 1:
            smallest = min(filled)
            two = best_two(gap + smallest, smallest)
            if not two:
                break
            filled.remove(smallest)
            for length in two:
                take(length)
                filled.append(length)
            give(smallest)
            gap = fill(filled, gap + smallest - sum(two))
        bins.append(filled)
    return bins


def pack(pieces: DataFrame, params: PackingParams, staging: Staging) -> DataFrame:
    """`pieces` with sequence_id and offset."""
    id_type = pieces.schema["doc_id"].dataType
    # As text, since pandas has no whole numbers with nulls.
    numbered = pieces.withColumns({"doc_id": F.col("doc_id").cast("string"), "_row": F.monotonically_increasing_id()})
    staged = staging.table(numbered)
    groups = max(1, -(-staged.count() // params.group_size))
    schema = T.StructType([
        *staged.drop("_row").schema.fields, T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ])
    order = ["length", "doc_id", "piece", "ids_crc32"]

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([*order, "_row"], ignore_index=True).drop(columns=["_group", "_row"])
        lengths = rows["length"].to_numpy()
        # The rows of one length follow each other; the next unused one of a length:
        cursor = np.searchsorted(lengths, np.arange(params.max_tokens + 1))
        sequence, offset = np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows), dtype=np.int64)
        for number, filled in enumerate(best_two_fit(lengths.tolist(), params.max_tokens)):
            at = 0
            for length in filled:
                row = cursor[length]
                cursor[length] += 1
                sequence[row], offset[row] = (int(key[0]) << 32) + number, at
                at += length
        return rows.assign(sequence_id=sequence, offset=offset)

    dealt = F.xxhash64("doc_id", "piece", "length", "ids_crc32", "_row")
    grouped = staged.withColumn("_group", F.pmod(dealt, F.lit(groups)))
    packed = grouped.groupBy("_group").applyInPandas(run, schema)
    return packed.withColumn("doc_id", F.col("doc_id").cast(id_type))


def pack_documents(
    docs: DataFrame, tokenizer: str | None = None, params: PackingParams = PackingParams(),
    with_ids: bool = False,
) -> DataFrame:
    """Tokenize, cut and pack: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = token_pieces(docs, tokenizer, params, with_ids=with_ids)
    return pack(pieces, params, Staging(docs.sparkSession))

"""Alignment of two tokenizers over whole documents, by fragments that compose.

A byte-level tokenizer (A) reads a space and the text, a merge model with pieces (B) reads the same
bytes. Byte offsets at which tokens of both end cut them into groups; tokens whose byte ranges
overlap are linked. How often two ids are linked is counted over the whole corpus, and each
document is told how its links score.

A fragment is a byte range of a document: the tokens that end inside it, of both sides, and its
cuts, the numbers of A and B tokens up to each common end. Tokens before the first cut are its open
prefix, those after the last its open suffix, the rest closed groups. Fragments compose
associatively: one's open suffix and the next one's open prefix become a closed group, or part of
an open end if a fragment has no cut at all. The empty fragment is neutral.

Long documents are cut into parts before white space, spread over tasks, tokenized there and cut
into fragments at plain byte offsets; a tree of grouped compositions, eight at a time, makes them
whole. Shorter documents are one fragment each and are not shuffled. Tokens are written to the
shared folder once, as two binary columns. One pass over them counts links per id pair; the most
frequent pairs, at most `frequent_pairs`, reach tasks as a broadcast array, and links of all other
pairs are joined with their counts in a shuffle, where no key is hot for want of frequency.

Token bytes: A's entries decoded byte-level, B's pieces in UTF-8 with U+2581 as space and byte
pieces as their byte. Strings of special tokens are plain text.

Defined cases: a text that is null, empty, or not restored by either side's bytes (one that holds
U+2581) has no tokens: counts are 0, the digest ''. Repeated rows and null ids have a row each. An
empty table gives no rows. Only the id and text columns are read, so other columns may have any
name.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.piece_codec import SPACE, PieceDecoder, cuttable, default_model, read_vocabulary
from stratalake.llm.spans import SpanMemo, cut_places
from stratalake.llm.textscan import Chunk, chunks
from stratalake.sources.staging import Staging


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@dataclass(frozen=True)
class AlignParams:
    # Documents of more bytes are spread over tasks, in parts of about this size.
    part_bytes: int = 1 << 16
    # Byte ranges of fragments inside a part.
    fragment_bytes: int = 1 << 14
    # Fragments composed by one step of the tree.
    fan_in: int = 8
    # Id pairs whose counts are broadcast, 13 bytes each; the others are joined.
    frequent_pairs: int = 1_000_000
    # Distinct spans remembered by one worker, about 100 bytes each.
    cached_spans: int = 500_000
    # Id pairs that a task counts before it hands them on.
    counted_pairs: int = 2_000_000


# --- the two tokenizers -------------------------------------------------------------------------

def byte_level_letters() -> dict[str, int]:
    """The byte each letter of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


class Side:
    """Bytes of every id: `size[id]` of them, and whether a text is restored."""

    def __init__(self, raw: list[bytes]):
        self.size = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        self.at = np.cumsum(self.size) - self.size
        self.blob = np.frombuffer(b"".join(raw), dtype=np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        until = np.cumsum(size)
        total = int(until[-1]) if len(until) else 0
        return self.blob[np.repeat(self.at[ids] - (until - size), size) + np.arange(total)]


class TwoTokenizers:
    def __init__(self, tokenizer: str, model: str, cached_spans: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        first = Tokenizer.from_file(tokenizer)
        first.encode_special_tokens = True
        letters = byte_level_letters()
        names = [first.id_to_token(i) for i in range(first.get_vocab_size())]
        # A special token's own letters need not be of the alphabet; it never occurs.
        self.a = Side([bytes(letters[c] for c in n) if all(c in letters for c in n) else n.encode() for n in names])
        words = read_vocabulary(model)
        second, pieces = sentencepiece.SentencePieceProcessor(model_file=model), PieceDecoder(words)
        self.b = Side([pieces.blob[p : p + n].tobytes() for p, n in zip(pieces.at.tolist(), pieces.size.tolist())])
        in_front = any(p.startswith((SPACE + "\t", SPACE + "\n")) for p in words.scores)
        if not cuttable(words.scores) or in_front or max(len(names), len(words.pieces)) > 1 << 16:
            raise ValueError("needs pieces with spaces in front and at most 65,536 ids a side")

        def encode_first(spans: list[bytes]) -> list[list[int]]:
            return [e.ids for e in first.encode_batch_fast([s.decode("utf-8") for s in spans], add_special_tokens=False)]

        def encode_second(spans: list[bytes]) -> list[list[int]]:
            # The library puts a space in front: the span's own, or one that stays a piece of its own.
            led = [s.startswith(b" ") for s in spans]
            found = second.encode([s.decode("utf-8")[own:] for s, own in zip(spans, led)], num_threads=1)
            return [
                ids if own and len(s) > 1 else [words.ids[SPACE]] if own else ids[1:]
                for s, own, ids in zip(spans, led, found)
            ]

        self.memo = SpanMemo([encode_first, encode_second], cached_spans)

    def tokens(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and the bounds of rows, ids of B and the bounds of rows."""
        (a, a_bounds), (b, b_bounds) = self.memo.tokens(chunk)
        return a, a_bounds, b, b_bounds

    def restored(self, chunk: Chunk, ids: np.ndarray, bounds: np.ndarray, side: Side) -> np.ndarray:
        """Which rows the ids' bytes give back."""
        size = side.size[ids]
        until = np.concatenate([[0], np.cumsum(size)])
        same = np.diff(until[bounds]) == np.diff(chunk.bounds)
        data = side.joined(ids)
        if len(data) == len(chunk.data) and same.all():
            wrong = np.flatnonzero(data != chunk.data)
            same[np.searchsorted(chunk.bounds, wrong, side="right") - 1] = False
            return same
        for row in np.flatnonzero(same):
            own = chunk.data[chunk.bounds[row] : chunk.bounds[row + 1]]
            same[row] = np.array_equal(data[until[bounds[row]] : until[bounds[row + 1]]], own)
        return same


_TOKENIZERS: dict[tuple, TwoTokenizers] = {}


def worker_tokenizers(tokenizer: str, model: str, params: AlignParams) -> TwoTokenizers:
    """One per worker process, kept between tasks."""
    key = tokenizer, model, params.cached_spans
    if key not in _TOKENIZERS:
        _TOKENIZERS[key] = TwoTokenizers(*key)
    return _TOKENIZERS[key]


# --- fragments ----------------------------------------------------------------------------------

def _none(dtype: str) -> np.ndarray:
    return np.zeros(0, dtype=dtype)


@dataclass(frozen=True)
class Fragment:
    """Tokens of both sides and the cuts among them, as counts of A and of B tokens before each."""

    a: np.ndarray
    b: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray

    @staticmethod
    def empty() -> Fragment:
        return Fragment(_none("<u2"), _none("<u2"), _none("<i4"), _none("<i4"))

    @property
    def prefix(self) -> tuple[list[int], list[int]]:
        """Tokens before the first cut: all of them if there is none."""
        if not len(self.cut_a):
            return self.a.tolist(), self.b.tolist()
        return self.a[: self.cut_a[0]].tolist(), self.b[: self.cut_b[0]].tolist()

    @property
    def closed(self) -> list[tuple[list[int], list[int]]]:
        return [
            (self.a[a0:a1].tolist(), self.b[b0:b1].tolist())
            for a0, a1, b0, b1 in zip(self.cut_a, self.cut_a[1:], self.cut_b, self.cut_b[1:])
        ]

    @property
    def suffix(self) -> tuple[list[int], list[int]]:
        if not len(self.cut_a):
            return [], []
        return self.a[self.cut_a[-1] :].tolist(), self.b[self.cut_b[-1] :].tolist()

    def __add__(self, after: Fragment) -> Fragment:
        return Fragment(
            np.concatenate([self.a, after.a]), np.concatenate([self.b, after.b]),
            np.concatenate([self.cut_a, after.cut_a + len(self.a)]).astype("<i4"),
            np.concatenate([self.cut_b, after.cut_b + len(self.b)]).astype("<i4"),
        )


def compose(fragments: list[Fragment]) -> Fragment:
    """The sum of fragments in their order, without copying the first ones again and again."""
    if not fragments:
        return Fragment.empty()
    a_before = np.cumsum([0, *(len(f.a) for f in fragments)])
    b_before = np.cumsum([0, *(len(f.b) for f in fragments)])
    return Fragment(
        np.concatenate([f.a for f in fragments]), np.concatenate([f.b for f in fragments]),
        np.concatenate([f.cut_a + n for f, n in zip(fragments, a_before)]).astype("<i4"),
        np.concatenate([f.cut_b + n for f, n in zip(fragments, b_before)]).astype("<i4"),
    )


def fragments_of(
    a: np.ndarray, b: np.ndarray, a_size: np.ndarray, b_size: np.ndarray, width: int
) -> list[Fragment]:
    """Tokens of one part cut into fragments: those that end within each `width` bytes."""
    a_end, b_end = np.cumsum(a_size[a]), np.cumsum(b_size[b])
    common = np.intersect1d(a_end, b_end, assume_unique=True)
    cut_a = np.searchsorted(a_end, common, side="right")
    cut_b = np.searchsorted(b_end, common, side="right")
    edges = np.arange(0, int(a_end[-1]) + width, width) if len(a_end) else np.zeros(1)
    in_a, in_b = np.searchsorted(a_end, edges, side="right"), np.searchsorted(b_end, edges, side="right")
    in_cut = np.searchsorted(common, edges, side="right")
    return [
        Fragment(
            a[in_a[i] : in_a[i + 1]].astype("<u2"), b[in_b[i] : in_b[i + 1]].astype("<u2"),
            (cut_a[in_cut[i] : in_cut[i + 1]] - in_a[i]).astype("<i4"),
            (cut_b[in_cut[i] : in_cut[i + 1]] - in_b[i]).astype("<i4"),
        )
        for i in range(len(edges) - 1)
    ]


# --- tokens of documents ------------------------------------------------------------------------

def _led(texts: pa.Array) -> pa.Array:
    """A space in front of what is not empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    led = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string()))
    return pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, led)


def _binary(parts: list[np.ndarray]) -> pa.Array:
    return pa.array([p.tobytes() for p in parts], pa.binary())


def _short_tokens(docs: DataFrame, tokenizer: str, model: str, params: AlignParams) -> DataFrame:
    """doc_id, copies, a, b of documents that are one fragment each; a and b without cuts."""
    schema = _token_schema(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = worker_tokenizers(tokenizer, model, params)
        for batch in batches:
            for chunk in chunks(_led(batch.column(1))):
                a, a_bounds, b, b_bounds = both.tokens(chunk)
                kept = both.restored(chunk, a, a_bounds, both.a) & both.restored(chunk, b, b_bounds, both.b)
                a, b = a.astype("<u2"), b.astype("<u2")
                columns = [
                    [x[s:e] if k else x[:0] for s, e, k in zip(bounds[:-1].tolist(), bounds[1:].tolist(), kept.tolist())]
                    for x, bounds in ((a, a_bounds), (b, b_bounds))
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.first_row, chunk.rows), pa.array([1] * chunk.rows, pa.int64()),
                        *map(_binary, columns),
                    ],
                    names=schema.names,
                )

    return docs.mapInArrow(run, schema)


def _token_schema(docs: DataFrame) -> T.StructType:
    return T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("copies", T.LongType()),
        T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType()),
    ])


_TOKENS = ["a", "b", "cut_a", "cut_b"]
_FRAGMENT = "key long, no long, valid boolean, a binary, b binary, cut_a binary, cut_b binary"


def _parts(long: DataFrame, params: AlignParams) -> DataFrame:
    """key, start, part: texts with their space in front, cut before white space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), _led(batch.column(1)).to_pylist()):
                raw = text.encode()
                cuts = cut_places(np.frombuffer(raw, dtype=np.uint8))
                starts = [0]
                while True:
                    at = int(np.searchsorted(cuts, starts[-1] + params.part_bytes))
                    if at == len(cuts):
                        break
                    starts.append(int(cuts[at]))
                for first in range(0, len(starts), 64):
                    own = starts[first : first + 64]
                    ends = [*starts[first + 1 : first + 64], (starts + [len(raw)])[first + len(own)]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([key] * len(own), pa.int64()), pa.array(own, pa.int64()),
                            pa.array([raw[x:y].decode() for x, y in zip(own, ends)], pa.string()),
                        ],
                        names=["key", "start", "part"],
                    )

    return long.select("key", "text").mapInArrow(run, "key long, start long, part string")


def _part_fragments(parts: DataFrame, tokenizer: str, model: str, params: AlignParams) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = worker_tokenizers(tokenizer, model, params)
        for batch in batches:
            for chunk in chunks(batch.column(2)):
                a, a_bounds, b, b_bounds = both.tokens(chunk)
                kept = both.restored(chunk, a, a_bounds, both.a) & both.restored(chunk, b, b_bounds, both.b)
                for row in range(chunk.rows):
                    place = chunk.first_row + row
                    made = fragments_of(
                        a[a_bounds[row] : a_bounds[row + 1]], b[b_bounds[row] : b_bounds[row + 1]],
                        both.a.size, both.b.size, params.fragment_bytes,
                    ) if kept[row] else [Fragment.empty()]
                    start = batch.column(1)[place].as_py()
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([batch.column(0)[place].as_py()] * len(made), pa.int64()),
                            pa.array([start + i * params.fragment_bytes for i in range(len(made))], pa.int64()),
                            pa.array([bool(kept[row])] * len(made)),
                            *(_binary([getattr(f, c) for f in made]) for c in ("a", "b", "cut_a", "cut_b")),
                        ],
                        names=["key", "no", "valid", "a", "b", "cut_a", "cut_b"],
                    )

    return parts.mapInArrow(run, _FRAGMENT)


def _composed(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("no")
    valid = bool(rows["valid"].all())
    whole = compose([
        Fragment(*(np.frombuffer(r[c], dtype=d) for c, d in (("a", "<u2"), ("b", "<u2"), ("cut_a", "<i4"), ("cut_b", "<i4"))))
        for r in rows.to_dict("records")
    ]) if valid else Fragment.empty()
    return pd.DataFrame({
        "key": [rows["key"].iloc[0]], "no": [rows["no"].iloc[0]], "valid": [valid],
        "a": [whole.a.tobytes()], "b": [whole.b.tobytes()],
        "cut_a": [whole.cut_a.tobytes()], "cut_b": [whole.cut_b.tobytes()],
    })


def reduce_tree(fragments: DataFrame, params: AlignParams, staging: Staging) -> DataFrame:
    """One fragment per key. `no` is where a fragment starts; those that start in the same stretch
    of bytes are composed, and stretches grow `fan_in` times with every level."""
    level = staging.table(fragments)
    last, width = level.agg(F.max("no")).first()[0], params.fragment_bytes
    whole = last is None
    while not whole:
        width *= params.fan_in
        whole = last < width
        grouped = level.withColumn("_group", F.floor(F.col("no") / width).cast("long"))
        level = staging.table(grouped.groupBy("key", "_group").applyInPandas(_composed, _FRAGMENT))
    return level


def align_tokens(
    docs: DataFrame, tokenizer: str, model: str, params: AlignParams, staging: Staging,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """row, doc_id, copies, a, b, cut_a, cut_b: ids of both sides (little-endian, 16 bits) and, for
    long documents, the cuts among them, written to the shared folder. `copies` equal rows of a long
    document are one row here."""
    table = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    short = table.where(size <= params.part_bytes)
    copies = table.where(size > params.part_bytes).groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("copies"))
    # Numbers given when written, so they stay.
    long = staging.table(copies.withColumn("key", F.monotonically_increasing_id()))
    parts = _parts(long, params)
    spread = parts.repartition("key", "start")
    whole = reduce_tree(_part_fragments(spread, tokenizer, model, params), params, staging)
    # Their cuts come from the composition; documents of one fragment are cut when they are read.
    long_tokens = long.join(whole, "key").select("doc_id", "copies", *_TOKENS)
    tokens = _short_tokens(short, tokenizer, model, params).unionByName(long_tokens, allowMissingColumns=True)
    return staging.table(tokens.withColumn("row", F.monotonically_increasing_id()))


# --- groups and links ---------------------------------------------------------------------------

@dataclass
class Aligned:
    """Groups and links of some documents, all bounds by document."""

    a: np.ndarray
    b: np.ndarray
    a_bounds: np.ndarray
    b_bounds: np.ndarray
    cut_a: np.ndarray  # A tokens up to each common end
    cut_b: np.ndarray
    groups: np.ndarray  # bounds of the groups of each document
    pairs: np.ndarray  # a << 16 | b of every link
    links: np.ndarray  # bounds of the links of each document


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data or b"", dtype="<u2")
    return raw[bounds[0] // 2 : bounds[-1] // 2].astype(np.int64), (bounds - bounds[0]) // 2


def align(
    a: np.ndarray, a_bounds: np.ndarray, b: np.ndarray, b_bounds: np.ndarray,
    a_size: np.ndarray, b_size: np.ndarray, cuts: tuple[np.ndarray, np.ndarray] | None = None,
) -> Aligned:
    """Both sides cover the same bytes of each document, so documents may follow each other."""
    a_end, b_end = np.cumsum(a_size[a]), np.cumsum(b_size[b])
    total = int(a_end[-1]) if len(a_end) else 0
    in_a, in_b = np.zeros(total + 1, dtype=bool), np.zeros(total + 1, dtype=bool)
    in_a[a_end], in_b[b_end] = True, True
    ends = np.flatnonzero(in_a | in_b)
    common = np.flatnonzero(in_a & in_b) if cuts is None else a_end[cuts[0] - 1]
    cut_a, cut_b = cuts if cuts is not None else (
        np.searchsorted(a_end, common, side="right"), np.searchsorted(b_end, common, side="right")
    )
    until = np.concatenate([[0], a_end])[a_bounds]
    # Between two neighbouring ends lies one link: the token of A and that of B there.
    pairs = a[np.searchsorted(a_end, ends)] << 16 | b[np.searchsorted(b_end, ends)]
    return Aligned(
        a, b, a_bounds, b_bounds, cut_a, cut_b, np.searchsorted(common, until, side="right"),
        pairs, np.searchsorted(ends, until, side="right"),
    )


_DIGITS = 6


def _decimal_table(ids: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of every id, one more place for what follows, and how many places count."""
    size = np.fromiter((len(str(i)) for i in range(ids)), dtype=np.int64, count=ids)
    text = np.frombuffer("".join(str(i).ljust(_DIGITS) for i in range(ids)).encode(), dtype=np.uint8)
    return text.reshape(ids, _DIGITS), size


_DECIMALS = _decimal_table(1 << 16)


def group_texts(x: Aligned) -> tuple[bytes, np.ndarray]:
    """`a1,a2|b1;a3|b2,b3` of all documents, and the bounds of each document's bytes.

    Every token is followed by one sign: `,` inside a side, `|` after A's, `;` after B's. A
    document's bytes end with that last sign, which is not part of its text.
    """
    n = len(x.a) + len(x.b)
    if not n:
        return b"", np.zeros(len(x.groups), dtype=np.int64)
    # A token's place: its own number and the other side's tokens of groups up to it.
    a_group = np.searchsorted(x.cut_a, np.arange(len(x.a)), side="right")
    b_group = np.searchsorted(x.cut_b, np.arange(len(x.b)), side="right")
    a_place = np.arange(len(x.a)) + np.concatenate([[0], x.cut_b])[a_group]
    b_place = np.arange(len(x.b)) + x.cut_a[b_group]
    ids, sign = np.empty(n, dtype=np.int64), np.full(n, ord(","), dtype=np.uint8)
    ids[a_place], ids[b_place] = x.a, x.b
    sign[a_place[x.cut_a - 1]] = ord("|")
    sign[b_place[x.cut_b - 1]] = ord(";")
    digits, size = _DECIMALS
    out, size = digits[ids], size[ids]
    out[np.arange(n), size] = sign
    text = out[np.arange(_DIGITS) <= size[:, None]].tobytes()
    until = np.concatenate([[0], np.cumsum(size + 1)])
    return text, until[x.a_bounds + x.b_bounds]


def _aligned(batches: Iterator[pa.RecordBatch], both: TwoTokenizers) -> Iterator[tuple[pa.RecordBatch, Aligned]]:
    """Some rows at a time, so that links take bounded memory beyond one document's; a document
    with cuts comes alone."""
    for batch in batches:
        size = np.cumsum(pc.binary_length(batch["a"]).to_numpy(zero_copy_only=False))
        composed = np.flatnonzero(pc.is_valid(batch["cut_a"]).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = size[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(size, before + (1 << 20), side="right")))
            later = composed[np.searchsorted(composed, at) :][:1]
            cuts = None
            if len(later) and later[0] == at:
                to = at + 1
                cuts = tuple(np.frombuffer(batch[c][at].as_py(), dtype="<i4").astype(np.int64) for c in ("cut_a", "cut_b"))
            elif len(later):
                to = min(to, int(later[0]))
            part = batch.slice(at, to - at)
            yield part, align(*_flat(part["a"]), *_flat(part["b"]), both.a.size, both.b.size, cuts)
            at = to


def count_pairs(tokens: DataFrame, tokenizer: str, model: str, params: AlignParams) -> DataFrame:
    """pair (a << 16 | b), n: how many links of the corpus hold two ids linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = worker_tokenizers(tokenizer, model, params)
        pairs, counts = [_none("i8")], [_none("i8")]

        def merge() -> None:
            own, where = np.unique(np.concatenate(pairs), return_inverse=True)
            total = np.bincount(where, weights=np.concatenate(counts), minlength=len(own))
            pairs[:], counts[:] = [own], [total.astype(np.int64)]

        def hand_on() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(pairs[0], pa.int64()), pa.array(counts[0], pa.int64())], names=["pair", "n"])
            pairs[:], counts[:] = [_none("i8")], [_none("i8")]
            return out

        for part, x in _aligned(batches, both):
            copies = part["copies"].to_numpy(zero_copy_only=False)
            own, where = np.unique(x.pairs, return_inverse=True)
            weight = np.bincount(where, weights=np.repeat(copies, np.diff(x.links)), minlength=len(own))
            pairs.append(own)
            counts.append(weight.astype(np.int64))
            if sum(map(len, pairs)) > params.counted_pairs:
                merge()
                if len(pairs[0]) > params.counted_pairs // 2:
                    yield hand_on()
        merge()
        yield hand_on()

    local = tokens.select("copies", *_TOKENS).mapInArrow(run, "pair long, n long")
    return local.groupBy("pair").agg(F.sum("n").alias("n"))


def _frequent(counted: DataFrame, limit: int) -> int:
    """The least count such that at most `limit` pairs have it; powers of two are told apart in 16 steps."""
    step = F.floor(F.log2("n") * 16)
    sizes = counted.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("pairs"), F.min("n").alias("least"))
    least, total = None, 0
    # 64 powers of two at most, so at most 1,024 rows.
    for r in sorted(sizes.collect(), key=lambda r: -r["least"]):
        total += r["pairs"]
        if total > limit:
            break
        least = r["least"]
    return least if least is not None else (1 << 62)


def align_documents(
    docs: DataFrame, tokenizer: str | None = None, model: str | None = None, params: AlignParams = AlignParams(),
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    spark, staging = docs.sparkSession, Staging(docs.sparkSession)
    tokenizer, model = tokenizer or default_tokenizer(), model or default_model()
    tokens = align_tokens(docs, tokenizer, model, params, staging, doc_id, text)
    counted = staging.table(count_pairs(tokens, tokenizer, model, params))
    best = counted.groupBy(F.col("pair").bitwiseAND(F.lit(0xFFFF)).alias("b")).agg(F.max("n").alias("most"))
    # At most 65,536 ids of B.
    pairs = staging.table(
        counted.join(F.broadcast(best), F.col("pair").bitwiseAND(F.lit(0xFFFF)) == F.col("b"))
        .select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    )
    least = _frequent(pairs, params.frequent_pairs)
    known = pairs.where(F.col("n") >= least).orderBy("pair").toArrow()
    frequent = spark.sparkContext.broadcast((
        known.column("pair").to_numpy(), known.column("n").to_numpy(), known.column("best").to_numpy(),
    ))
    scored = tokens.select("row", "copies", "doc_id", *_TOKENS).mapInArrow(
        _scorer(tokenizer, model, params, frequent), T.StructType([
            *(tokens.schema[c] for c in ("row", "copies", "doc_id")),
            *(T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")),
            T.StructField("groups_sha256", T.StringType()),
            T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.LongType())),
        ]),
    )
    if pairs.where(F.col("n") < least).isEmpty():
        whole = scored.drop("pairs", "times")
    else:
        scored = staging.table(scored)
        rare = (
            scored.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link"))
            .select("row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
            .join(pairs.where(F.col("n") < least), "pair")
            .groupBy("row").agg(
                F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
                F.sum(F.col("times") * F.col("n")).alias("more_sum"),
            )
        )
        whole = scored.drop("pairs", "times").join(rare, "row", "left").withColumns({
            "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)),
            "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0)),
        })
    repeated = whole.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def _scorer(tokenizer: str, model: str, params: AlignParams, frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = worker_tokenizers(tokenizer, model, params)
        known, counts, best = frequent.value
        for part, x in _aligned(batches, both):
            own, where = np.unique(x.pairs, return_inverse=True)
            place = np.minimum(np.searchsorted(known, own), max(0, len(known) - 1))
            found = known[place] == own if len(known) else np.zeros(len(own), dtype=bool)
            count = np.where(found, counts[place], 0) if len(known) else np.zeros(len(own), dtype=np.int64)
            is_best = found & best[place] if len(known) else found
            sums = [np.concatenate([[0], np.cumsum(v[where])]) for v in (is_best.astype(np.int64), count)]
            n_best, count_sum = (np.diff(s[x.links]) for s in sums)
            text, bounds = group_texts(x)
            digests = [
                hashlib.sha256(text[s : e - 1]).hexdigest() if e > s else ""
                for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist())
            ]
            rest = [([], [])] * part.num_rows if found.all() else [
                tuple(v.tolist() for v in np.unique(own[where[s:e]][~found[where[s:e]]], return_counts=True))
                for s, e in zip(x.links[:-1].tolist(), x.links[1:].tolist())
            ]
            longs = [
                np.diff(x.a_bounds), np.diff(x.b_bounds), np.diff(x.groups), np.diff(x.links), n_best, count_sum,
            ]
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), part.column(1), part.column(2), *(pa.array(v, pa.int64()) for v in longs),
                    pa.array(digests, pa.string()), pa.array([p for p, _ in rest], lists),
                    pa.array([t for _, t in rest], lists),
                ],
                names=[
                    "row", "copies", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                    "groups_sha256", "pairs", "times",
                ],
            )

    return run


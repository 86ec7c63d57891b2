"""SentencePiece encoding and decoding of merge (BPE) models, by a table of prefixes.

Encoding. Every prefix of a text has exactly one encoding, so a table of the last token of each
prefix holds them all. An automaton over the vocabulary lists the tokens that end at a place; the
last token is the one that is compatible with the last token of the prefix before it. Two tokens
are compatible if merging their joint text ends in just these two: their merges are undone in
reverse order, and no pair that meets at the border may have been merged first. A sequence is an
encoding if and only if all its neighbours are compatible. Ids are then recovered backwards.

A model is a list of pieces with scores. The pair with the best score merges first, of equal ones
the leftmost; characters without a piece become their bytes' pieces, or the unknown id. Spaces
read as U+2581, and one is put in front of a text that is not empty.

Texts are cut before white space that follows something else, which no piece reaches across (a
model with such a piece is encoded uncut); every distinct span is solved once by a worker and
looked up by its 64-bit hash. A span of n characters takes 4 n bytes of table.

Decoding. Pieces are joined with U+2581 as space, without the first space; a run of byte pieces is
read as UTF-8, bytes that are none of it as U+FFFD each; control pieces are silent and the unknown
id reads as in the library.

Defined cases: a null or empty text has no ids and decodes to an empty text. U+2581 in a text is a
space. Repeated rows and null ids have a row each. An empty table gives no rows. Only the id and
text columns are read, so other columns may have any name.
"""

from __future__ import annotations

import codecs
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.spans import SpanMemo
from stratalake.llm.textscan import chunks

SPACE = "▁"
_UNKNOWN_TEXT = " ⁇ "
_OPENS = "\t\n" + SPACE


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass(frozen=True)
class CodecParams:
    # Distinct spans remembered by one worker, about 50 bytes each; beyond it the memory starts anew.
    cached_spans: int = 1_000_000
    # Pairs of tokens whose compatibility a worker remembers.
    cached_pairs: int = 1_000_000


@dataclass(frozen=True)
class Vocabulary:
    pieces: list[str]
    scores: dict[str, float]  # of ordinary pieces
    ids: dict[str, int]
    byte_ids: list[int]  # empty without byte fallback
    unknown: int
    control: frozenset[int]


def read_vocabulary(path: str) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    special = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
    plain = [i for i in range(len(pieces)) if not any(f(i) for f in special)]
    byte_ids = [i for i in range(len(pieces)) if model.is_byte(i)]
    byte_ids.sort(key=lambda i: int(pieces[i][3:5], 16))
    return Vocabulary(
        pieces, {pieces[i]: model.get_score(i) for i in plain}, {pieces[i]: i for i in plain},
        byte_ids, model.unk_id(), frozenset(i for i in range(len(pieces)) if model.is_control(i)),
    )


def cuttable(pieces: Iterable[str]) -> bool:
    """Whether no piece reaches across a place where texts are cut."""
    return not any(b in _OPENS and a not in _OPENS for p in pieces for a, b in pairwise(p))


class PrefixEncoder:
    """Tokens are numbers: the reachable pieces, then characters that only occur inside pieces."""

    def __init__(self, words: Vocabulary, cached_pairs: int = 1_000_000):
        import ahocorasick

        self.words, self.cached_pairs = words, cached_pairs
        ranks = {s: i for i, s in enumerate(sorted(set(words.scores.values()), reverse=True))}
        self.of_piece = {p: ranks[s] for p, s in words.scores.items()}
        # The merges that build each piece alone; a piece that merges into others never occurs.
        built = {p: self._merge(p) for p in words.scores}
        texts = [p for p, (left, _) in built.items() if len(left) == 1]
        texts += sorted({c for p in words.scores for c in p} - set(texts))
        number = {t: i for i, t in enumerate(texts)}
        self.n = len(texts)
        self.out = [words.ids.get(t, -1) for t in texts]
        self.left, self.right, self.rank = [-1] * self.n, [-1] * self.n, [-1] * self.n
        # Undoing merges by rank is right if no merge inside a piece ranks after a later one.
        self.ordered = True
        for i, text in enumerate(texts):
            merges = built[text][1] if len(text) > 1 else []
            if merges:
                self.left[i], self.right[i] = number[merges[-1][1]], number[merges[-1][2]]
                self.rank[i] = merges[-1][0]
                self.ordered &= all(a[0] <= b[0] for a, b in pairwise(merges))
        self.texts = texts
        self.joint = {}
        for piece, rank in self.of_piece.items():
            for k in range(1, len(piece)):
                pair = number.get(piece[:k]), number.get(piece[k:])
                if None not in pair:
                    self.joint[pair[0] * self.n + pair[1]] = rank
        self.automaton = ahocorasick.Automaton()
        for i, text in enumerate(texts):
            self.automaton.add_word(text, (len(text), i))
        self.automaton.make_automaton()
        self.cuttable = cuttable(texts)
        self._seen: dict[int, bool] = {}

    def _merge(self, text: str) -> tuple[list[str], list[tuple[int, str, str]]]:
        """The definition, for single pieces and pairs of them: best pair first, leftmost first."""
        parts, merges = list(text), []
        while True:
            best = min(
                ((self.of_piece[a + b], i) for i, (a, b) in enumerate(pairwise(parts)) if a + b in self.of_piece),
                default=None,
            )
            if best is None:
                return parts, merges
            i = best[1]
            merges.append((best[0], parts[i], parts[i + 1]))
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def _compatible(self, a: int, b: int) -> bool:
        if not self.ordered:
            return self._merge(self.texts[a] + self.texts[b])[0] == [self.texts[a], self.texts[b]]
        rank, joint, n = self.rank, self.joint, self.n
        limit = len(self.of_piece) + 1
        while True:
            # Would the border have been merged before the merge undone last?
            if joint.get(a * n + b, limit) < limit:
                return False
            if rank[a] > rank[b]:
                limit, a = rank[a], self.right[a]
            elif rank[b] >= 0:
                # Of equal ranks the leftmost comes first, and the border lies left of b's merge.
                limit, b = rank[b] + 1, self.left[b]
            else:
                return True

    def last_tokens(self, text: str) -> array:
        """The last token of every prefix, -1 where it is a character outside the vocabulary."""
        last = array("i", [-1]) * (len(text) + 1)
        seen, n = self._seen, self.n
        if len(seen) > self.cached_pairs:
            seen.clear()
        for end, (length, token) in self.automaton.iter(text):
            if last[end + 1] >= 0:
                continue
            start = end + 1 - length
            before = last[start]
            # Nothing merges with a character outside the vocabulary, nor with the beginning.
            if before >= 0:
                pair = before * n + token
                fits = seen.get(pair)
                if fits is None:
                    fits = seen[pair] = self._compatible(before, token)
                if not fits:
                    continue
            last[end + 1] = token
        return last

    def encode(self, text: str) -> list[int]:
        """Ids of a text as it stands: U+2581 for spaces, nothing put in front."""
        last, ids, at = self.last_tokens(text), [], len(text)
        while at:
            token = last[at]
            own = self.out[token] if token >= 0 else -1
            if own >= 0:
                ids.append(own)
                at -= len(self.texts[token])
            else:
                raw = text[at - 1].encode()
                ids += [self.words.byte_ids[x] for x in reversed(raw)] if self.words.byte_ids else [self.words.unknown]
                at -= 1
        ids.reverse()
        if not self.words.byte_ids:
            # The library writes a run of unknown characters as one id.
            ids = [x for i, x in enumerate(ids) if x != self.words.unknown or i == 0 or ids[i - 1] != x]
        return ids

    def encode_spans(self, spans: list[bytes]) -> list[list[int]]:
        return [self.encode(s.decode("utf-8").replace(" ", SPACE)) for s in spans]


def _one_byte(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("stratalake.one_byte", _one_byte)


class PieceDecoder:
    def __init__(self, words: Vocabulary):
        plain = {i: p.replace(SPACE, " ").encode() for p, i in words.ids.items()}
        plain |= {i: bytes([x]) for x, i in enumerate(words.byte_ids)}
        plain |= {words.unknown: _UNKNOWN_TEXT.encode()} | {i: b"" for i in words.control}
        raw = [plain.get(i, p.replace(SPACE, " ").encode()) for i, p in enumerate(words.pieces)]
        self.blob = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.size = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        self.at = np.cumsum(self.size) - self.size
        self.control = np.zeros(len(raw), dtype=bool)
        self.control[list(words.control)] = True
        self.led = np.array([i in plain and p.startswith(SPACE) for i, p in enumerate(words.pieces)])

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The texts of rows of ids."""
        size = self.size[ids]
        until = np.concatenate([[0], np.cumsum(size)])
        data = self.blob[np.repeat(self.at[ids] - until[:-1], size) + np.arange(until[-1])].tobytes()
        spoken = np.append(np.flatnonzero(~self.control[ids]), len(ids))
        first = spoken[np.searchsorted(spoken, bounds[:-1])]
        led = np.zeros(len(first), dtype=bool)
        inside = first < bounds[1:]
        led[inside] = self.led[ids[first[inside]]]
        starts, ends = until[bounds[:-1]] + led, until[bounds[1:]]
        # A run of bytes ends at a control piece, too.
        breaks = until[:-1][self.control[ids]]
        out = []
        for a, b in zip(starts.tolist(), ends.tolist()):
            inner = breaks[np.searchsorted(breaks, a, side="right") : np.searchsorted(breaks, b)].tolist() if len(breaks) else []
            out.append("".join(
                data[x:y].decode("utf-8", "stratalake.one_byte") for x, y in pairwise([a, *inner, b])
            ))
        return out


_CODECS: dict[tuple, tuple[PrefixEncoder, SpanMemo, PieceDecoder]] = {}


def worker_codec(path: str, params: CodecParams) -> tuple[PrefixEncoder, SpanMemo, PieceDecoder]:
    """One per worker process, kept between tasks."""
    if (path, params) not in _CODECS:
        words = read_vocabulary(path)
        encoder = PrefixEncoder(words, params.cached_pairs)
        memo = SpanMemo([encoder.encode_spans], params.cached_spans)
        _CODECS[path, params] = encoder, memo, PieceDecoder(words)
    return _CODECS[path, params]


def _with_front(texts: pa.Array) -> pa.Array:
    """Spaces for U+2581, and one in front of what is not empty."""
    texts = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), SPACE, " ")
    led = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string()))
    return pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, led)


def encode_decode(
    docs: DataFrame, model: str | None = None, params: CodecParams = CodecParams(),
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """doc_id, ids array<int>, decoded string of every row, in one pass over the whole texts."""
    path = model or default_model()
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("decoded", T.StringType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, memo, decoder = worker_codec(path, params)
        for batch in batches:
            for chunk in chunks(_with_front(batch.column(1))):
                if encoder.cuttable:
                    ((ids, bounds),) = memo.tokens(chunk)
                else:
                    data = chunk.data.tobytes()
                    found = encoder.encode_spans([data[a:b] for a, b in pairwise(chunk.bounds.tolist())])
                    bounds = np.concatenate([[0], np.cumsum([len(x) for x in found], dtype=np.int64)])
                    ids = np.array([x for row in found for x in row], dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first_row, chunk.rows), lists, pa.array(decoder.decode(ids, bounds), pa.string())],
                    names=schema.names,
                )

    return docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).mapInArrow(run, schema)


def decode_ids(
    encoded: DataFrame, model: str | None = None, params: CodecParams = CodecParams(),
    doc_id: str = "doc_id", ids: str = "ids",
) -> DataFrame:
    """doc_id and decoded text of rows of ids; null lists decode to an empty text."""
    path = model or default_model()
    schema = T.StructType([
        T.StructField("doc_id", encoded.schema[doc_id].dataType), T.StructField("decoded", T.StringType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = worker_codec(path, params)[2]
        for batch in batches:
            lists = batch.column(1)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            flat = pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            texts = decoder.decode(flat, np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=schema.names)

    return encoded.select(
        encoded[doc_id].alias("doc_id"), encoded[ids].cast("array<int>").alias("ids")
    ).mapInArrow(run, schema)


def codec_digests(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids (decimal, joined by commas) and of the decoded text."""
    both = encode_decode(docs, model)
    return both.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

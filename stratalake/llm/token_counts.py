"""Token counts under a unigram tokenizer, by a Viterbi pass that carries counts only.

The vocabulary is the pieces of a SentencePiece model with their scores. A space reads as the piece
letter U+2581, and a text that does not start with one gets one. A text is cut before every space,
or with `space_runs` before the first space of every run, so that pieces of several spaces apply; a
vocabulary with a piece that reaches over such a cut is refused then. Within a segment an
Aho-Corasick automaton enumerates all pieces that end at a place; the best score and the number of
pieces of the best path are all that is kept, for as many places as the longest piece has letters.
Ties go to the piece that starts first, as in the tokenizers library. A character without a piece
of its own costs ten less than the lowest score and falls back to one token for each of its bytes.

Every distinct segment is solved once by a worker and then looked up by its hash, a chunk of text
at a time. A text beyond a chunk is cut where segments start, and a segment that is longer still
is fed to the automaton in blocks, so a task holds the text itself and little more.

Defined cases: a null or empty text has no tokens. Repeated rows and null ids have a row each. An
empty table gives no rows. Only the id and text columns are read.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from stratalake.llm.textscan import CHUNK_BYTES, Chunk, chunks, span_hashes

SPACE = "▁"
UNKNOWN_PENALTY = 10.0


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass(frozen=True)
class TokenCountParams:
    # Distinct segments remembered by one worker; beyond it the memory starts anew.
    cached_segments: int = 1_000_000
    # Cut before runs of spaces only, not before each space (Metaspace without split).
    space_runs: bool = False


def read_pieces(path: str) -> list[tuple[str, float]]:
    """Ordinary pieces of a SentencePiece model and their scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
    return [
        (model.id_to_piece(i), model.get_score(i))
        for i in range(model.get_piece_size()) if not any(f(i) for f in special)
    ]


class UnigramCounter:
    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        # Special pieces have score 0 and count, too.
        self.unknown = min(0.0, min((s for _, s in pieces), default=0.0)) - UNKNOWN_PENALTY
        self.longest = max((len(p) for p, _ in pieces), default=1)

    def count(self, segment: str) -> int:
        """Pieces on the best path through one segment."""
        return self.count_blocks([segment])

    def count_blocks(self, blocks: Iterable[str]) -> int:
        """Pieces on the best path through a segment given in blocks.

        Scores and counts of the places a piece can reach back to are kept in a ring.
        """
        width, unknown = self.longest + 1, self.unknown
        score, pieces = [0.0] * width, [0] * width
        tail, base, at = "", 0, 0
        best, longest, count, alone = -np.inf, 0, 0, False
        for block in blocks:
            # Pieces that end here may start in what the last blocks ended with.
            seen = tail + block
            first, stop = base - len(tail), base + len(block)
            matches = self.automaton.iter(seen)
            while at < stop:
                end, match = next(matches, (len(seen), None))
                end += first
                if end < base:
                    continue
                while at < end:
                    # All pieces that end with this character are known.
                    if not alone:
                        own = score[at % width] + unknown
                        if own > best:
                            best, count = own, pieces[at % width] + len(seen[at - first].encode())
                    at += 1
                    score[at % width], pieces[at % width] = best, count
                    best, longest, count, alone = -np.inf, 0, 0, False
                if match is None:
                    break
                length, own = match
                alone = alone or length == 1
                start = (end + 1 - length) % width
                total = score[start] + own
                # The longest match starts first; a later start must be better to win.
                if total > best or (total == best and length > longest):
                    best, longest, count = total, length, pieces[start] + 1
            base, tail = stop, seen[max(0, len(seen) - self.longest + 1) :]
        return pieces[at % width]


def _blocks(data: np.ndarray, head: str, size: int = 1 << 16) -> Iterator[str]:
    """A long segment as text, block by block, its spaces as the piece letter."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    yield head
    for i in range(0, len(data), size):
        yield decoder.decode(data[i : i + size].tobytes(), i + size >= len(data)).replace(" ", SPACE)


class SegmentCounts:
    """Token counts of segments, by hash."""

    def __init__(self, path: str, params: TokenCountParams):
        pieces = read_pieces(path)
        if params.space_runs and any(re.search(f"[^{SPACE}]{SPACE}", p) for p, _ in pieces):
            raise ValueError(f"{path} has pieces that reach from a word to the next space")
        self.counter, self.limit, self.space_runs = UnigramCounter(pieces), params.cached_segments, params.space_runs
        self._reset()

    def _reset(self) -> None:
        self.keys, self.tokens = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int32)

    def _cuts(self, data: np.ndarray) -> np.ndarray:
        """Spaces before which a text is cut, but for one at its beginning."""
        spaces = data == 32
        cut = spaces[1:] & ~spaces[:-1] if self.space_runs else spaces[1:]
        return np.flatnonzero(cut) + 1

    def of_chunk(self, chunk: Chunk, long: int = 2 * CHUNK_BYTES) -> np.ndarray:
        """Tokens of every row."""
        if chunk.rows == 1 and len(chunk.data) > long:
            return np.array([sum(self._of_long(chunk.data, long // 2))], dtype=np.int64)
        return self._of_rows(chunk)

    def _of_long(self, data: np.ndarray, size: int) -> Iterator[int]:
        """Tokens of the parts of one long text, cut where segments start."""
        at = 0
        while at < len(data):
            to = at + size
            cuts = self._cuts(data[at:to]) if to < len(data) else np.array([len(data) - at])
            if len(cuts):
                to = at + int(cuts[-1])
                yield int(self._of_rows(Chunk(0, data[at:to], np.array([0, to - at], dtype=np.int64)))[0])
            else:
                while to < len(data) and not len(cuts):
                    # The byte before the window tells whether its first one continues a run.
                    cuts = self._cuts(data[to - 1 : to + size])
                    to = to - 1 + int(cuts[0]) if len(cuts) else to + size
                to = min(to, len(data))
                head = "" if data[at] == 32 else SPACE
                yield self.counter.count_blocks(_blocks(data[at:to], head))
            at = to

    def _of_rows(self, chunk: Chunk) -> np.ndarray:
        data = chunk.data
        filled = chunk.bounds[:-1][np.diff(chunk.bounds) > 0]
        starts = np.unique(np.concatenate([filled, self._cuts(data)]))
        if not len(starts):
            return np.zeros(chunk.rows, dtype=np.int64)
        ends = np.append(starts[1:], len(data))
        row = np.searchsorted(chunk.bounds, starts, side="right") - 1
        # A segment reads alike with its space and, at the beginning of a text, without.
        words = starts + (data[starts] == 32)
        hashes = span_hashes(chunk, words, ends)
        keys, example, of_segment = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.limit:
            self._reset()
        place = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), dtype=bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == keys[inside]
        if not known.all():
            text, new = data.tobytes(), example[~known]
            solved = [
                self.counter.count(SPACE + text[a:b].decode("utf-8", "replace").replace(" ", SPACE))
                for a, b in zip(words[new].tolist(), ends[new].tolist())
            ]
            self.tokens = np.insert(self.tokens, place[~known], solved)
            self.keys = np.insert(self.keys, place[~known], keys[~known])
            place = np.searchsorted(self.keys, keys)
        return np.bincount(row, weights=self.tokens[place][of_segment], minlength=chunk.rows).astype(np.int64)


_COUNTERS: dict[tuple[str, TokenCountParams], SegmentCounts] = {}


def count_tokens(
    docs: DataFrame, model: str | None = None, params: TokenCountParams = TokenCountParams(),
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """doc_id and n_tokens of every row."""
    path = model or default_model()
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (path, params)
        if key not in _COUNTERS:
            _COUNTERS[key] = SegmentCounts(*key)
        counter = _COUNTERS[key]
        for batch in batches:
            # The piece letter itself reads as a space.
            texts = pc.replace_substring(batch.column(1), SPACE, " ")
            counts = [counter.of_chunk(c) for c in chunks(texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(counts) if counts else [], pa.int64())],
                names=["doc_id", "n_tokens"],
            )

    return docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).mapInArrow(run, schema)

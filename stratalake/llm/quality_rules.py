"""Quality rules under weak supervision: rules vote, their accuracies are estimated, documents are
kept by the posterior probability that they are good.

A pass over the whole texts counts what the rules look at. Every rule votes good, bad or abstains.
Documents with the same votes are alike to the model, so that expectation-maximisation works on
counts of vote patterns, of which there are at most 3 to the number of rules. The model is a
probability that a document is good and, for each rule, how probable each of its votes is for good
and for bad documents. It starts from rules that are right four times in five.

A document fails outright (`base_failed`) with fewer than 50 words, or if more than half of its
words lie in repeated three-word windows.

Defined cases: a null or empty text has zero counts and fails. Rows with equal ids or texts are
judged alike, and each counts in the estimates. An empty table gives no rows. Only the id and text
columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.textscan import Chunk, chunks, code_point_counts, mix, span_hashes, window_hashes, words
from stratalake.sources.staging import Staging


@dataclass(frozen=True)
class QualityParams:
    min_words: int = 50
    max_repeat_percent: int = 50
    window: int = 3
    threshold: float = 0.5
    rounds: int = 200
    tolerance: float = 1e-9
    # Weight of the starting votes, in documents, so that a rule that hardly votes keeps its start.
    prior_weight: float = 20.0


# ---- counts ----

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".!?"]] = True

COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_stop_lines", "n_letter_words", "n_distinct_words", "n_stop_words",
]

# Function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in is that for was on with as by this "
    "le la les de des du et en un une est que qui dans pour "
    "der die das und ist in den von zu mit sich auf für nicht "
    "el los las del y se un una por con para su al"
).split()


def _word_hash(word: str) -> int:
    raw = np.frombuffer(word.encode(), dtype=np.uint8)
    chunk = Chunk(0, raw, np.array([0, len(raw)]))
    return int(span_hashes(chunk, np.array([0]), np.array([len(raw)]), lower=True)[0])


def _per_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def count_chunk(chunk: Chunk, window: int, stop_hashes: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of every row of a chunk."""
    data, n = chunk.data, chunk.rows
    found = words(chunk)
    row, first = found.row, found.first
    hashes = span_hashes(chunk, found.starts, found.ends)
    lower = span_hashes(chunk, found.starts, found.ends, lower=True)
    own = mix(hashes + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    # Windows that occur twice in a row, and the words they cover.
    seen = window_hashes(hashes, window)
    inside = row[: len(seen)] == row[len(row) - len(seen) :]
    at = np.flatnonzero(inside)
    keyed = mix(seen[at] + row[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, place, times = np.unique(keyed, return_inverse=True, return_counts=True)
    twice = at[times[place] > 1]
    covered = np.zeros(len(hashes), dtype=bool)
    for i in range(window):
        covered[twice + i] = True

    # Lines: cut at line feeds and at the ends of rows; only those with a word count.
    feeds = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate([chunk.bounds[:-1], feeds + 1]))
    starts = starts[starts < len(data)] if len(data) else starts[:0]
    ends = np.concatenate([starts[1:], [len(data)]]) if len(starts) else starts
    ends = ends - ((ends > starts) & (data[ends - 1] == 10) if len(starts) else 0)
    has_word = np.searchsorted(found.starts, starts) < np.searchsorted(found.starts, ends)
    starts, ends = starts[has_word], ends[has_word]
    of_line = np.searchsorted(chunk.bounds, starts, side="right") - 1
    lines = mix(span_hashes(chunk, starts, ends) + of_line.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first_line = np.unique(lines, return_index=True)
    repeated = np.ones(len(lines), dtype=bool)
    repeated[first_line] = False
    last_word = np.searchsorted(found.starts, ends) - 1
    stops = _STOP[data[found.ends[last_word] - 1]] if len(starts) else np.zeros(0, dtype=bool)

    letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
    with_letter = letters[found.ends] > letters[found.starts]
    _, first_word = np.unique(own, return_index=True)
    fresh = np.zeros(len(own), dtype=bool)
    fresh[first_word] = True

    return {
        "n_words": found.counts,
        "word_chars": _per_row(code_point_counts(data, found.starts, found.ends), first),
        "n_symbols": _per_row(_SYMBOL[data], chunk.bounds),
        "n_dup_lines": np.bincount(of_line[repeated], minlength=n),
        "n_repeat_words": _per_row(covered, first),
        "n_lines": np.bincount(of_line, minlength=n),
        "n_stop_lines": np.bincount(of_line[stops], minlength=n),
        "n_letter_words": _per_row(with_letter, first),
        "n_distinct_words": _per_row(fresh, first),
        "n_stop_words": _per_row(np.isin(lower, stop_hashes), first),
    }


def text_counts(docs: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """doc_id and COUNTS of every row."""
    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in COUNTS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stop_hashes = np.array([_word_hash(w) for w in sorted(set(STOP_WORDS))], dtype=np.uint64)
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                counts = count_chunk(chunk, params.window, stop_hashes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(chunk.first_row, chunk.rows),
                     *(pa.array(counts[c].astype(np.int64)) for c in COUNTS)],
                    names=["doc_id", *COUNTS],
                )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


# ---- votes ----

GOOD, ABSTAIN, BAD = 1, 0, -1


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, BAD).when(good, GOOD).otherwise(ABSTAIN)


def rule_votes() -> dict[str, Column]:
    """Each rule's vote, from the counts. Shares are compared without division."""
    c = {name: F.col(name) for name in COUNTS}
    w, lines = c["n_words"], c["n_lines"]
    enough = w > 0
    return {
        "symbols": _vote(enough & (50 * c["n_symbols"] < c["word_chars"]), 20 * c["n_symbols"] > c["word_chars"]),
        "word_length": _vote(enough & c["word_chars"].between(3 * w, 9 * w), (c["word_chars"] < 2 * w) | (c["word_chars"] > 14 * w)),
        "letters": _vote(enough & (10 * c["n_letter_words"] >= 9 * w), 10 * c["n_letter_words"] < 7 * w),
        "stop_words": _vote(25 * c["n_stop_words"] >= 3 * w, enough & (50 * c["n_stop_words"] < w)),
        "line_ends": _vote((lines > 0) & (10 * c["n_stop_lines"] >= 7 * lines), (lines > 1) & (4 * c["n_stop_lines"] < lines)),
        "dup_lines": _vote((lines > 2) & (c["n_dup_lines"] == 0), (c["n_dup_lines"] > 2) & (4 * c["n_dup_lines"] > lines)),
        "repeats": _vote(enough & (20 * c["n_repeat_words"] < w), 10 * c["n_repeat_words"] > 3 * w),
        "vocabulary": _vote(5 * c["n_distinct_words"] >= 2 * w, 10 * c["n_distinct_words"] < w),
    }


# ---- model ----

@dataclass
class VoteModel:
    """Probability of good, and of votes (bad, abstain, good) given bad and given good."""

    prior: float
    votes: np.ndarray  # rules x 2 x 3

    def log_odds(self) -> np.ndarray:
        """What each vote adds to the log odds of good: rules x 3."""
        return np.log(self.votes[:, 1]) - np.log(self.votes[:, 0])


def estimate(patterns: np.ndarray, counts: np.ndarray, params: QualityParams = QualityParams()) -> VoteModel:
    """Expectation-maximisation over vote patterns (rows of -1, 0, 1) and how often they occur."""
    rules = patterns.shape[1]
    start = np.tile(np.array([[0.5, 0.375, 0.125], [0.125, 0.375, 0.5]]), (rules, 1, 1))
    model = VoteModel(0.7, start)
    if not counts.sum():
        return model
    shown = np.stack([patterns == v for v in (BAD, ABSTAIN, GOOD)], axis=2).astype(float)
    before = -np.inf
    for _ in range(params.rounds):
        good = np.log(model.prior) + (shown * np.log(model.votes[:, 1])).sum(axis=(1, 2))
        bad = np.log1p(-model.prior) + (shown * np.log(model.votes[:, 0])).sum(axis=(1, 2))
        either = np.logaddexp(good, bad)
        share = np.exp(good - either)
        fit = float((counts * either).sum() / counts.sum())
        weights = np.stack([counts * (1 - share), counts * share])
        votes = np.einsum("cp,prv->rcv", weights, shown) + params.prior_weight * start
        prior = float(np.clip((weights[1].sum() + 0.7) / (counts.sum() + 1), 1e-3, 1 - 1e-3))
        model = VoteModel(prior, votes / votes.sum(axis=2, keepdims=True))
        if abs(fit - before) < params.tolerance:
            break
        before = fit
    return model


def judge_documents(docs: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """doc_id, the counts of the contract, base_failed, quality (posterior) and kept."""
    staging = Staging(docs.sparkSession)
    votes = rule_votes()
    counted = staging.table(text_counts(docs, params))
    voted = counted.select("*", *(v.alias(f"_{n}") for n, v in votes.items()))
    names = [f"_{n}" for n in votes]
    # At most 3 ** len(votes) rows.
    rows = voted.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).orderBy(*names).collect()
    patterns = np.array([[r[n] for n in names] for r in rows], dtype=int).reshape(len(rows), len(names))
    model = estimate(patterns, np.array([r["n"] for r in rows], dtype=float), params)
    odds = F.lit(float(np.log(model.prior) - np.log1p(-model.prior)))
    for name, (bad, abstain, good) in zip(names, model.log_odds().tolist()):
        odds = odds + F.when(F.col(name) == BAD, bad).when(F.col(name) == GOOD, good).otherwise(abstain)
    failed = (F.col("n_words") < params.min_words) | (
        100 * F.col("n_repeat_words") > params.max_repeat_percent * F.col("n_words")
    )
    judged = voted.withColumn("base_failed", failed).withColumn("quality", 1 / (1 + F.exp(-odds)))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("quality") >= params.threshold)).alias("kept"), "quality",
    )

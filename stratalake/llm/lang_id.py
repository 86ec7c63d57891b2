"""Language identification: multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased, every run of other characters is one space, and the n-grams of one to
three characters are hashed into a fixed number of buckets. Counts are taken over all training
rows; the model is a matrix of log probabilities, one row per bucket and one column per language,
broadcast to the scoring tasks.

Defined cases: a text that is null, empty or without a letter is `und` with score 0; rows with a
null language or a null id are not learned from; with no training row at all, every text is `und`.
Repeated rows count as often as they occur. Equal posteriors go to the language first by code
point. Columns of the input named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.textscan import Chunk, chunks, mix

UNDETERMINED = "und"


@dataclass(frozen=True)
class LangIdParams:
    buckets: int = 1 << 16
    orders: tuple[int, ...] = (1, 2, 3)
    smoothing: float = 0.5
    # The model holds buckets x languages numbers; more languages than this are refused.
    max_languages: int = 256


@dataclass
class LangIdModel:
    languages: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray
    params: LangIdParams


def any_language(params: LangIdParams = LangIdParams()) -> LangIdModel:
    """Stands in where nothing could be learned: every text with a letter is in its one language."""
    return LangIdModel(["any"], np.zeros(1), np.zeros((params.buckets, 1)), params)


_FOLD: np.ndarray | None = None


def _fold_table() -> np.ndarray:
    """Code point to its lower-case letter, or to a space."""
    global _FOLD
    if _FOLD is None:
        table = np.full(0x110000, 32, dtype=np.uint32)
        for c in range(0x110000):
            if (ch := chr(c)).isalpha():
                low = ch.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _FOLD = table
    return _FOLD


def _grams(chunk: Chunk, params: LangIdParams) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of a chunk and the row of each, rows ascending within an order."""
    text = chunk.data.tobytes().decode("utf-8", "replace")
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    heads = np.zeros(len(chunk.data) + 1, dtype=np.int64)
    np.cumsum((chunk.data & 0xC0) != 0x80, out=heads[1:])
    row = np.repeat(np.arange(chunk.rows), np.diff(heads[chunk.bounds]))
    codes = _fold_table()[points]
    same = np.empty(len(codes), dtype=bool)
    if len(codes):
        same[0] = False
        same[1:] = row[1:] == row[:-1]
    keep = codes != 32
    keep[1:] |= (codes[:-1] != 32) & same[1:]
    codes, row = codes[keep].astype(np.uint64), row[keep]
    buckets, rows = [], []
    for order in params.orders:
        n = len(codes) - order + 1
        if n <= 0:
            continue
        value = np.full(n, order, dtype=np.uint64)
        for i in range(order):
            value = value * np.uint64(0x200005) + codes[i : i + n]
        # A gram starts with a letter or holds one; the space alone says nothing.
        whole = (row[:n] == row[order - 1 :]) & ((codes[:n] != 32) | (order > 1))
        buckets.append((mix(value[whole]) % np.uint64(params.buckets)).astype(np.int64))
        rows.append(row[:n][whole])
    if not buckets:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(buckets), np.concatenate(rows)


_PART = 1 << 12
# Bytes of text at once: every one becomes an entry of each order and language.
_CHUNK = 1 << 18


def train(docs: DataFrame, text: str, lang: str, params: LangIdParams = LangIdParams()) -> LangIdModel:
    """Learn from all rows with a language: counts per task, then summed part by part."""
    rows = docs.where(F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")
    )
    schema = "lang string, part int, task int, docs long, counts binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        counts: dict[str, np.ndarray] = {}
        n_docs: dict[str, int] = {}
        for batch in batches:
            names = batch.column("lang").to_pylist()
            for chunk in chunks(batch.column("text"), _CHUNK):
                here = names[chunk.first_row : chunk.first_row + chunk.rows]
                own = sorted(set(here))
                place = {name: i for i, name in enumerate(own)}
                of_row = np.array([place[x] for x in here], dtype=np.int64)
                bucket, row = _grams(chunk, params)
                flat = np.bincount(
                    of_row[row] * params.buckets + bucket, minlength=len(own) * params.buckets
                ).reshape(len(own), params.buckets)
                for name, i in place.items():
                    if name in counts:
                        counts[name] += flat[i]
                    else:
                        counts[name] = flat[i].copy()
                    n_docs[name] = n_docs.get(name, 0) + int((of_row == i).sum())
        task = TaskContext.get().partitionId()
        for name, total in counts.items():
            parts = [total[i : i + _PART].astype(np.int64).tobytes() for i in range(0, params.buckets, _PART)]
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([name] * len(parts), pa.string()),
                "part": pa.array(range(len(parts)), pa.int32()),
                "task": pa.array([task % 64] * len(parts), pa.int32()),
                "docs": pa.array([n_docs[name]] * len(parts), pa.int64()),
                "counts": pa.array(parts, pa.binary()),
            })

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, dtype=np.int64) for x in rows["counts"])
        head = rows.iloc[:1]
        return head.assign(docs=rows["docs"].sum(), counts=[total.tobytes()])

    per_task = rows.mapInArrow(count, schema)
    some = per_task.groupBy("lang", "part", "task").applyInPandas(add, schema)
    summed = some.groupBy("lang", "part").applyInPandas(add, schema)
    # At most max_languages * buckets counts.
    limit = params.max_languages * -(-params.buckets // _PART)
    got = sorted(summed.limit(limit + 1).collect(), key=lambda r: (r["lang"], r["part"]))
    if len(got) > limit:
        raise ValueError(f"more than {params.max_languages} languages")
    languages = sorted({r["lang"] for r in got})
    counts = np.zeros((len(languages), params.buckets))
    n_docs = np.zeros(len(languages))
    for r in got:
        i = languages.index(r["lang"])
        counts[i, r["part"] * _PART : r["part"] * _PART + _PART] = np.frombuffer(r["counts"], dtype=np.int64)
        n_docs[i] = r["docs"]
    smooth = counts + params.smoothing
    log_prob = np.log(smooth / smooth.sum(axis=1, keepdims=True)).T
    log_prior = np.log(n_docs / max(1.0, n_docs.sum()))
    return LangIdModel(languages, log_prior, np.ascontiguousarray(log_prob), params)


def _score_chunk(chunk: Chunk, model: LangIdModel) -> tuple[np.ndarray, np.ndarray]:
    """Index of the best language (-1: undetermined) and its posterior."""
    bucket, row = _grams(chunk, model.params)
    best, score = np.full(chunk.rows, -1), np.zeros(chunk.rows)
    if not model.languages or not len(bucket):
        return best, score
    total = np.stack(
        [np.bincount(row, weights=model.log_prob[bucket, k], minlength=chunk.rows) for k in range(len(model.languages))],
        axis=1,
    )
    has = np.bincount(row, minlength=chunk.rows) > 0
    total += model.log_prior
    top = total.max(axis=1)
    best[has] = total.argmax(axis=1)[has]
    score[has] = (1 / np.exp(total - top[:, None]).sum(axis=1))[has]
    return best, score


def identify(
    docs: DataFrame, model: LangIdModel, text: str = "text", pred: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """`docs` with the predicted language of every whole text and its posterior."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in docs.schema.fields if f.name not in (pred, score)]
    names = [f.name for f in kept]
    schema = T.StructType(
        [*kept, T.StructField(pred, T.StringType()), T.StructField(score, T.DoubleType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        labels = np.array([*own.languages, UNDETERMINED], dtype=object)
        for batch in batches:
            best, scores = np.full(batch.num_rows, -1), np.zeros(batch.num_rows)
            for chunk in chunks(batch.column(text), _CHUNK):
                to = chunk.first_row + chunk.rows
                best[chunk.first_row : to], scores[chunk.first_row : to] = _score_chunk(chunk, own)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(labels[best], pa.string()), pa.array(scores)],
                names=[*names, pred, score],
            )

    return docs.mapInArrow(run, schema)


def fold(doc_id: Column, folds: int = 5) -> Column:
    """Fold of a document: crc32 of its id as text, modulo `folds`; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def identify_documents(docs: DataFrame, params: LangIdParams = LangIdParams()) -> DataFrame:
    """Learn on the folds other than 0 and predict for all rows: doc_id, held_out, lang_pred, score."""
    model = train(docs.where(fold(F.col("doc_id")) != 0), "text", "lang", params)
    rows = docs.select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "text"
    )
    return identify(rows, model).drop("text")

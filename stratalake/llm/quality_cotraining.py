"""Quality scores by co-training a text view and a page view.

The text view sees what a text is written with: shares of characters and words. The page view sees
what is known about a page without reading it as text: its source, language tag and length, and
its layout in lines. Each view has a logistic classifier. It starts from a bounded sample of the
labelled documents; in every round each classifier scores all documents that have no label, and
the documents it is surest of, good and bad, go to the other one with its verdict as their label: a
share of all distinct ones by quantiles of its own scores, which grows from round to round. In the
end both are calibrated on labelled documents that neither has seen, and a logistic model of the two
calibrated views scores all documents.

Features are computed by one pass over whole texts and staged; rounds and scores read the features.
Documents without a label count once for each vector of features, so that a group of copies does not
speak for the rest, and whatever their id. Nothing that was passed on reaches the driver: Newton
steps add up gradients and curvatures in tasks, and two thresholds per view come from one aggregate.

Defined cases: a null or empty text has zero shares and is scored by them. Null source or language
is a value of its own. Several labels of one document are averaged; a null label is none. Labels of
unknown documents are ignored. Rows with equal ids are scored separately. Without labels of both
kinds every score is the share of good labels, or 0.5 without any. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.quality_rules import STOP_WORDS, _per_row, _word_hash, count_chunk
from stratalake.llm.textscan import chunks
from stratalake.sources.staging import Staging


@dataclass(frozen=True)
class CoTrainingParams:
    # Labelled documents that are fitted on, by a threshold on their hash, a fifth of them for
    # calibration.
    max_labelled: int = 20_000
    rounds: int = 3
    # Of every thousand distinct unlabelled documents those that a view passes on, of each kind, in the
    # first round: the second passes twice as many, and so on.
    passed: float = 10
    # Weight of a passed document against a labelled one.
    passed_weight: float = 0.5
    ridge: float = 1.0
    source_buckets: int = 32
    lang_buckets: int = 8
    threshold: float = 0.5


# ---- features ----

_MARKS = [c for c in range(33, 127) if not chr(c).isalnum()]
N_TEXT = 6 + len(_MARKS) + 3
N_LAYOUT = 6


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(1, whole)


def view_features(docs: DataFrame) -> DataFrame:
    """doc_id, source, lang and the arrays `text_view` and `layout` of every row."""
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("source", T.StringType()), T.StructField("lang", T.StringType()),
        T.StructField("text_view", T.ArrayType(T.FloatType())), T.StructField("layout", T.ArrayType(T.FloatType())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stop_hashes = np.array([_word_hash(w) for w in sorted(set(STOP_WORDS))], dtype=np.uint64)
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                c = count_chunk(chunk, 3, stop_hashes)
                w, size = c["n_words"], np.diff(chunk.bounds)
                row = np.repeat(np.arange(chunk.rows), size)
                marks = np.bincount(row * 256 + chunk.data, minlength=chunk.rows * 256).reshape(chunk.rows, 256)
                shares = np.log1p(1000 * marks / np.maximum(1, size)[:, None])
                plain = [
                    _share(c["n_symbols"], c["word_chars"]), _share(c["word_chars"], w) / 10,
                    _share(c["n_letter_words"], w), _share(c["n_distinct_words"], w),
                    _share(c["n_repeat_words"], w), _share(c["n_stop_words"], w),
                ]
                kinds = [marks[:, a:b].sum(axis=1) / np.maximum(1, size) for a, b in ((48, 58), (65, 91), (128, 256))]
                text_view = np.column_stack([*plain, shares[:, _MARKS], *kinds]).astype(np.float32)
                layout = np.column_stack([
                    np.log1p(size), np.log1p(c["n_lines"]), np.log1p(_share(size, c["n_lines"])),
                    _share(c["n_dup_lines"], c["n_lines"]), _share(_per_row(chunk.data == 32, chunk.bounds), size),
                    size == 0,
                ]).astype(np.float32)

                def lists(values: np.ndarray) -> pa.Array:
                    at = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
                    return pa.ListArray.from_arrays(pa.array(at), pa.array(values.ravel()))

                here = slice(chunk.first_row, chunk.first_row + chunk.rows)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(n)[here] for n in ("doc_id", "source", "lang")), lists(text_view), lists(layout)],
                    names=[f.name for f in schema.fields],
                )

    return docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), "text"
    ).mapInArrow(run, schema)


def _with_buckets(features: DataFrame, params: CoTrainingParams) -> DataFrame:
    """The hashed places of source and language; 0 is null."""
    def bucket(name: str, n: int):
        return F.coalesce(F.pmod(F.xxhash64(name), F.lit(n - 1)) + 1, F.lit(0)).cast("int")

    return features.withColumn("_source", F.when(F.col("source").isNull(), 0).otherwise(bucket("source", params.source_buckets))).withColumn(
        "_lang", F.when(F.col("lang").isNull(), 0).otherwise(bucket("lang", params.lang_buckets))
    )


def _matrices(text_view: np.ndarray, layout: np.ndarray, source, lang, params: CoTrainingParams):
    """Inputs of the two classifiers, each with a constant."""
    one = np.ones((len(source), 1))
    page = np.concatenate([
        layout, np.eye(params.source_buckets)[np.asarray(source, dtype=int)],
        np.eye(params.lang_buckets)[np.asarray(lang, dtype=int)], one,
    ], axis=1)
    return np.concatenate([text_view, one], axis=1), page


# ---- classifiers ----

def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def _slope_and_bend(x: np.ndarray, y: np.ndarray, weight: np.ndarray, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = _sigmoid(x @ beta)
    return x.T @ (weight * (y - p)), (x * (weight * p * (1 - p))[:, None]).T @ x


def fit_logistic(
    x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float,
    more: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]] | None = None,
) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last column, a constant, is not shrunk.

    `more` gives slope and bend of rows that are elsewhere.
    """
    scale = np.append(np.full(x.shape[1] - 1, ridge), 1e-6)
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        parts = [_slope_and_bend(x, y, weight, beta), *([more(beta)] if more else [])]
        slope = sum(p[0] for p in parts) - scale * beta
        bend = sum(p[1] for p in parts) + np.diag(scale)
        step = np.linalg.solve(bend, slope)
        beta += step * min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-7:
            break
    return beta


@dataclass
class _Views:
    """Weights of both views, their calibration and the model that joins them."""

    text: np.ndarray
    page: np.ndarray
    calibrations: tuple[np.ndarray, np.ndarray] | None = None
    joint: np.ndarray | None = None

    def raw(self, x: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Scores of both views before calibration, which tell apart what rounds to 0 or 1."""
        return np.column_stack([x[0] @ self.text, x[1] @ self.page])

    def logits(self, x: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        raw = self.raw(x)
        if self.calibrations:
            raw = np.column_stack([raw[:, i] * c[0] + c[1] for i, c in enumerate(self.calibrations)])
        return np.clip(raw, -30, 30)

    def calibrate(self, x, y: np.ndarray) -> None:
        raw, one = self.logits(x), np.ones(len(y))
        self.calibrations = tuple(fit_logistic(np.column_stack([raw[:, i], one]), y, one, 1e-2) for i in range(2))
        self.joint = fit_logistic(np.column_stack([self.logits(x), one]), y, one, 1e-2)

    def score(self, x) -> np.ndarray:
        """Calibrated probabilities of the views and the joint one."""
        logits = self.logits(x)
        joint = np.column_stack([logits, np.ones(len(logits))]) @ self.joint if self.joint is not None else logits.sum(axis=1)
        return np.column_stack([_sigmoid(logits), _sigmoid(joint)])


def _rows_of(batch: pa.RecordBatch, params: CoTrainingParams):
    def dense(name: str) -> np.ndarray:
        return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).astype(float)

    return _matrices(dense("text_view"), dense("layout"), batch.column("_source"), batch.column("_lang"), params)


def _scored(features: DataFrame, views: _Views, params: CoTrainingParams) -> DataFrame:
    """`features` with text_score, meta_score and quality_score."""
    kept = features.schema.fields
    names = ["text_score", "meta_score", "quality_score"]
    schema = T.StructType([*kept, *(T.StructField(n, T.DoubleType()) for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = views.score(_rows_of(batch, params))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *(pa.array(np.ascontiguousarray(c)) for c in score.T)],
                    names=[*(f.name for f in kept), *names],
                )

    return features.mapInArrow(run, schema)


def _raw_scored(features: DataFrame, views: _Views, params: CoTrainingParams) -> DataFrame:
    """`features` with text_raw and meta_raw."""
    kept = features.schema.fields
    schema = T.StructType([*kept, *(T.StructField(n, T.DoubleType()) for n in ("text_raw", "meta_raw"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                raw = views.raw(_rows_of(batch, params))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *(pa.array(np.ascontiguousarray(c)) for c in raw.T)], names=schema.names
                )

    return features.mapInArrow(run, schema)


def _gathered(rows: list, params: CoTrainingParams):
    return _matrices(
        np.array([r["text_view"] for r in rows], dtype=float).reshape(len(rows), N_TEXT),
        np.array([r["layout"] for r in rows], dtype=float).reshape(len(rows), N_LAYOUT),
        [r["_source"] for r in rows], [r["_lang"] for r in rows], params,
    )


_INPUTS = ["text_view", "layout", "_source", "_lang"]


def _sample(features: DataFrame, marked: DataFrame, params: CoTrainingParams) -> list:
    """About `max_labelled` distinct labelled documents at most, in a fixed order that has nothing to
    do with their content: those whose hash lies below a threshold, which one count gives."""
    place = F.xxhash64(F.lit("co-training"), "doc_id", *_INPUTS)
    labelled = features.select("doc_id", *_INPUTS).join(marked, "doc_id").withColumn("_place", place)
    known = labelled.groupBy("_place").agg(F.first(F.struct("doc_id", *_INPUTS, "_y")).alias("_row"))
    total = known.count()
    if total > params.max_labelled:
        # A little less, so that chance does not exceed it.
        share = 0.98 * params.max_labelled / total
        known = known.where(F.col("_place") < int(-(2**63) + share * 2**64))
    rows = known.select("_place", "_row.*").collect()
    return sorted(rows, key=lambda r: r["_place"])


def distinct_vectors(features: DataFrame, marked: DataFrame) -> DataFrame:
    """The inputs of documents without a label, once each. Null ids have no label."""
    known = marked.select(F.col("doc_id").alias("_known"))
    free = features.join(known, F.col("doc_id") == F.col("_known"), "left_anti").select(*_INPUTS)
    grouped = free.groupBy(F.xxhash64(*_INPUTS).alias("_vector")).agg(F.first(F.struct(*_INPUTS)).alias("_row"))
    return grouped.select("_row.*")


def surest(scored: DataFrame, share: float) -> list[DataFrame]:
    """For each view the rows that it passes on, with its verdict `_label`: the `share` it gives the
    least and the `share` it gives the greatest scores, by quantiles of its own scores."""
    names = ["text_raw", "meta_raw"]
    # Two numbers per view.
    edges = scored.agg(*[F.percentile_approx(n, [share, 1 - share], 10_000).alias(n) for n in names]).first()
    out = []
    for name in names:
        if edges[name] is None or edges[name][0] >= edges[name][1]:
            # A view that does not tell documents apart passes nothing on.
            out.append(scored.where(F.lit(False)).withColumn("_label", F.lit(0.0)))
            continue
        low, high = edges[name]
        verdict = F.when(F.col(name) >= high, 1.0).when(F.col(name) <= low, 0.0)
        out.append(scored.withColumn("_label", verdict).where(F.col("_label").isNotNull()))
    return out


def _elsewhere(given: DataFrame, view: int, params: CoTrainingParams) -> Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Slope and bend of passed documents, added up in tasks: one small row per partition."""

    def more(beta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(beta)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            slope, bend = np.zeros(n), np.zeros((n, n))
            for batch in batches:
                if batch.num_rows:
                    y = batch.column("_label").to_numpy(zero_copy_only=False)
                    weight = np.full(len(y), params.passed_weight)
                    own = _slope_and_bend(_rows_of(batch, params)[view], y, weight, beta)
                    slope, bend = slope + own[0], bend + own[1]
            places = np.arange(n + n * n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(places), pa.array(np.concatenate([slope, bend.ravel()]))], names=["place", "part"]
            )

        # Summed in tasks, so that what arrives does not grow with the partitions.
        parts = given.select(*_INPUTS, "_label").mapInArrow(run, "place long, part double")
        sums = np.zeros(n + n * n)
        for r in parts.groupBy("place").agg(F.sum("part").alias("total")).collect():
            sums[r["place"]] = r["total"]
        return sums[:n], sums[n:].reshape(n, n)

    return more


def score_documents(
    docs: DataFrame, labels: DataFrame, params: CoTrainingParams = CoTrainingParams(), label: str = "quality",
    passed: list | None = None,
) -> DataFrame:
    """doc_id, text_score, meta_score, quality_score and kept of every row. `passed` takes, for each
    round, how many documents the text view and the page view passed on."""
    staging = Staging(docs.sparkSession)
    features = staging.table(_with_buckets(view_features(docs), params))
    marked = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        (F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("_y")
    )
    sample = _sample(features, marked, params)
    y = np.array([r["_y"] for r in sample], dtype=float)
    if len(set(y)) < 2:
        flat = F.lit(float(y.mean()) if len(y) else 0.5)
        return features.select(
            "doc_id", flat.alias("text_score"), flat.alias("meta_score"), flat.alias("quality_score"),
            (flat >= params.threshold).alias("kept"),
        )
    x = _gathered(sample, params)
    tested = np.arange(len(y)) % 5 == 0
    if len(set(y[tested])) < 2:
        tested[:] = True
    fitted = ~tested if len(set(y[~tested])) == 2 else np.ones(len(y), dtype=bool)
    free = staging.table(distinct_vectors(features, marked))

    given: list[DataFrame | None] = [None, None]
    for round_no in range(params.rounds + 1):
        one = np.ones(int(fitted.sum()))
        fits = [
            fit_logistic(
                x[i][fitted], y[fitted], one, params.ridge, _elsewhere(given[i], i, params) if given[i] is not None else None
            ) for i in range(2)
        ]
        views = _Views(*fits)
        views.calibrate(tuple(m[tested] for m in x), y[tested])
        if round_no == params.rounds:
            break
        scored = staging.table(_raw_scored(free, views, params))
        chosen = [staging.table(t) for t in surest(scored, params.passed / 1000 * (round_no + 1))]
        # Each view learns from the other one's verdicts.
        given = [chosen[1], chosen[0]]
        if passed is not None:
            passed.append(tuple(t.count() for t in chosen))
    return _scored(features, views, params).select(
        "doc_id", "text_score", "meta_score", "quality_score", (F.col("quality_score") >= params.threshold).alias("kept")
    )

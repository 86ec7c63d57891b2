"""A corpus in five stages: language, lines, near copies, source weights, packed sequences.

Each stage takes the table that the one before it wrote. All but the last return rows of
`documents`; the last returns the pieces and where they lie. Columns that no stage reads travel as one
struct, so they pass unchanged whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.lang_id import any_language, fold, identify, train
from stratalake.llm.line_dedup import LineDedupParams, dedup_lines
from stratalake.llm.mixing import take_mix
from stratalake.llm.ngram_join import keep_one_per_group
from stratalake.llm.packing import pack_documents
from stratalake.llm.workers import reach_workers
from stratalake.sources.staging import Staging


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_READ = ("doc_id", "text", "lang", "source")


def _carrying(stage: Stage) -> Stage:
    """`stage` on the columns that it may read, with all others in one more."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        others = [c for c in docs.columns if c not in _READ]
        if not others:
            return stage(spark, docs, sf_dir)
        carried = F.struct(*[docs[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(others)]).alias("carried")
        out = stage(spark, docs.select(*[c for c in docs.columns if c in _READ], carried), sf_dir)
        return out.select(*[
            F.col(f"carried.c{others.index(c)}").alias(c) if c in others else F.col(c) for c in docs.columns
        ])

    return run


@_carrying
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some language: those without a letter go, whatever could be learned."""
    reach_workers(spark)
    model = train(docs.where(fold(docs["doc_id"]) != 0), "text", "lang")
    named = identify(docs, model if model.languages else any_language(), pred="_language", score="_posterior")
    # Not by name: `und` may be a label of the table.
    return named.where(named["_posterior"] > 0).select(*docs.columns)


@_carrying
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that occur earlier; those that lose all their words go."""
    return dedup_lines(docs, LineDedupParams(short_repeats=True))


@_carrying
def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    reach_workers(spark)
    return keep_one_per_group(docs)


@_carrying
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    reach_workers(spark)
    return take_mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences."""
    reach_workers(spark)
    return pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_join", ngram_join),
    ("source_mix", source_mix),
    ("packing", packing),
]

# Rounding at random, tokenizers and lattices of components have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read again."""
    staging = Staging(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = staging.table(stage(spark, docs, sf_dir))
    return docs

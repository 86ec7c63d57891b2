"""One query per corpus operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratalake.llm.alignment import align_documents
from stratalake.llm.embedding_dedup import link_embeddings
from stratalake.llm.lang_id import identify_documents
from stratalake.llm.line_dedup import LineDedupParams, dedup_report
from stratalake.llm.mixing import mix
from stratalake.llm.ngram_join import join_documents
from stratalake.llm.packing import pack_documents
from stratalake.llm.piece_codec import codec_digests
from stratalake.llm.quality_cotraining import score_documents
from stratalake.llm.quality_rules import judge_documents
from stratalake.llm.token_counts import TokenCountParams, count_tokens
from stratalake.llm.turn_repair import repair_conversations
from stratalake.llm.warc import round_trip
from stratalake.llm.workers import reach_workers


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reach_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op2_quality_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_documents(_table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"))


def op5_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(_table(spark, sf_dir, "pages"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_table(spark, sf_dir, "documents"), params=TokenCountParams(space_runs=True))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_documents(_table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_report(_table(spark, sf_dir, "documents"), LineDedupParams(short_repeats=True))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_embeddings(_table(spark, sf_dir, "embeddings"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_documents(_table(spark, sf_dir, "documents"))


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(_table(spark, sf_dir, "conversations"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(_table(spark, sf_dir, "documents"))


def op13_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec_digests(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_source_mixing": op1_source_mixing,
    "op2_quality_cotraining": op2_quality_cotraining,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_warc_round_trip": op5_warc_round_trip,
    "op6_token_counts": op6_token_counts,
    "op7_quality_rules": op7_quality_rules,
    "op8_line_dedup": op8_line_dedup,
    "op9_embedding_near_dedup": op9_embedding_near_dedup,
    "op10_language_id": op10_language_id,
    "op11_turn_repair": op11_turn_repair,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_piece_codec": op13_piece_codec,
}

ORACLE_SQL: dict[str, str] = {}

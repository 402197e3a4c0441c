"""The registered queries of this package, each over its whole table, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm.chat_format import CHAT_SQL, control_conversation, format_turns, read_back
from tabloom.llm.decontaminate import contaminated
from tabloom.llm.embedding_dedup import near_duplicates
from tabloom.llm.filter_audit import audit_sql, filter_audit
from tabloom.llm.hard_negatives import NEGATIVES_SQL, hard_negatives
from tabloom.llm.jaccard_forest import jaccard_join
from tabloom.llm.language_id import identify
from tabloom.llm.license_scan import license_sql, scan_licenses
from tabloom.llm.line_dedup import repeated_lines
from tabloom.llm.lm_scoring import score_documents
from tabloom.llm.piece_encoding import encode_texts
from tabloom.llm.substring_dedup import remove_repeats
from tabloom.llm.url_filter import filter_urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_table(spark, sf_dir, "documents"))


def op2_jaccard_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(_table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "embeddings"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(_table(spark, sf_dir, "pages"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(format_turns(turns.unionByName(control_conversation(spark))))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_lines(_table(spark, sf_dir, "documents"))


def op9_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(_table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op12_recurrent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


_QUERIES = (
    op1_language_profiles, op2_jaccard_forest, op3_substring_dedup, op4_benchmark_decontamination, op5_embedding_dedup,
    op6_url_filter, op7_chat_format, op8_line_dedup, op9_piece_encoding, op10_license_scan, op11_hard_negatives, op12_recurrent_scores,
    op13_filter_audit,
)
_SQL = {"op7_chat_format": CHAT_SQL, "op10_license_scan": license_sql(), "op11_hard_negatives": NEGATIVES_SQL, "op13_filter_audit": audit_sql()}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)

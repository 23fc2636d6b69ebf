"""Registered queries of the operators, each over its whole table, and their
DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedlens.llm import oracle
from feedlens.llm.byte_bpe import bpe_report, public_vocabulary
from feedlens.llm.common import table
from feedlens.llm.conversation_repair import repair
from feedlens.llm.exact_dedup import exact_groups
from feedlens.llm.line_dedup import line_report
from feedlens.llm.mixing import mix_report
from feedlens.llm.ngram_join import similar_classes
from feedlens.llm.quality_crf import classify
from feedlens.llm.quality_rules import apply_rules
from feedlens.llm.secret_scan import find_secrets
from feedlens.llm.sharding import shard_documents
from feedlens.llm.source_audit import audit_sources
from feedlens.llm.substring_dedup import repeat_report
from feedlens.llm.token_files import token_report, write_token_files
from feedlens.session import table_path


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = table_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, public_vocabulary("word_bpe_49k.json"), added=True)
    return token_report(spark, path)


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_classes(table(spark, sf_dir, "documents"), n=4, percent=85)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe_report(table(spark, sf_dir, "documents"), public_vocabulary("byte_bpe_multi_50k.tiktoken"),
                      public_tokenizers.PATTERN)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_report(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))


def op8_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "documents")).drop("failed_rules")


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_sources(table(spark, sf_dir, "documents"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_sharding, op2_token_files, op3_ngram_join, op4_byte_bpe, op5_substring_dedup, op6_mixing, op7_line_dedup,
    op8_quality_crf, op9_exact_dedup, op10_quality_rules, op11_source_audit, op12_secret_scan, op13_conversation_repair)}

SQL = {
    "op1_sharding": oracle.SHARDING,
    "op3_ngram_join": oracle.NGRAM_JOIN,
    "op5_substring_dedup": oracle.SUBSTRING_DEDUP,
    "op7_line_dedup": oracle.LINE_DEDUP,
    "op9_exact_dedup": oracle.EXACT_DEDUP,
    "op10_quality_rules": oracle.QUALITY_RULES,
    "op11_source_audit": oracle.SOURCE_AUDIT,
    "op13_conversation_repair": oracle.CONVERSATION_REPAIR,
}

"""The registered queries of the operators: production parameters, whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (decontamination, langid, line_spread, merkle, mixing, near_dedup, prefix_trie, quality,
               quality_rules, sharding, toxicity, url_filter, warc)
from .frames import table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.digest(table(spark, sf_dir, "documents"))


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.label_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.digest(table(spark, sf_dir, "pages"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(table(spark, sf_dir, "pages"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_spread.digest(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.digest(table(spark, sf_dir, "conversations"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_sharding, op2_language_id, op3_order_minhash, op4_quality_classifier, op5_url_filters, op6_mixing,
    op7_warc, op8_line_dedup, op9_quality_rules, op10_benchmark_decontamination, op11_merkle_manifest,
    op12_prefix_trie, op13_toxicity,
)}

ORACLE_SQL: dict[str, str] = {
    "op5_url_filters": url_filter.SQL,
    "op6_mixing": mixing.SQL,
    "op8_line_dedup": line_spread.SQL,
    "op10_benchmark_decontamination": decontamination.SQL,
    "op11_merkle_manifest": merkle.SQL,
    "op12_prefix_trie": prefix_trie.SQL,
}

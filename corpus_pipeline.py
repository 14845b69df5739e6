"""From raw documents to shards: select, deduplicate, decontaminate, mix, shard.

Every stage is a function (spark, docs, sf_dir) -> DataFrame over all the rows
that its predecessor kept, and all but the last return the columns of
``documents``.  ``run`` writes each stage's rows as Parquet in the shared
checkpoint folder and reads them back, so a lost executor costs part of a stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trackcast.llm import decontamination, mixing, near_dedup, quality, sharding
from trackcast.llm.frames import stored, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier takes for sound and clean; it learns from ``labels``."""
    return quality.select_documents(docs, quality.rated(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates."""
    return near_dedup.deduplicate(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with items of ``benchmark``."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source mix takes them."""
    return mixing.mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with shard and slot."""
    return sharding.shard(docs)[0]


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
    ("shards", shards),
]

#: The first stage's model has no SQL form; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

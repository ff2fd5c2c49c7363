"""Corpus preparation: stages over documents, each written and reread as the next one's input.

Every stage calls one operator of ``leadgrid.llm`` over all rows its predecessor kept, and its
decisions take effect: rows go, repeat, or move to their shard.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadgrid.llm import decontam, mixing, quality, shards, simhash
from leadgrid.session import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labels of these documents, does not reject."""
    return quality.keep_good(docs, spark.read.parquet(f"{folder}/labels.parquet"))


def keep_first_copy(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document, that with the smallest id, of each SimHash near-duplicate group."""
    return simhash.keep_first(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without any ten-word window of a benchmark item."""
    return decontam.keep_clean(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as the target weights of their sources take them."""
    return mixing.repeat_by_mix(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with their shard of 16, their slot in it, and their shard among 17."""
    return shards.shard_documents(docs, [1.0] * 16).withColumn("law", F.lit("key"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("near_duplicates", keep_first_copy),
    ("decontamination", keep_uncontaminated),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

# Fitted models and fingerprints have no SQL form; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the documents of ``folder``."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, folder), name)
    return STAGES[-1][1](spark, docs, folder)

"""Corpus pipeline: quality rules, near-dedup, benchmark decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; between stages the rows are
written as Parquet into the shared folder and read again, so a lost executor never repeats an earlier stage.  All
stages but the last return the columns of ``documents``; the last adds ``shard`` and ``slot``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankeval.llm import decontaminate, mixing, quality, sharding, simhash
from rankeval.llm.common import materialise, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or stand too far from their language's reference go."""
    return quality.keep_good(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays: the one with the least doc_id."""
    return simhash.keep_first(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are repeated or left out by the rates that bring the domains to their target totals."""
    return mixing.apply_rates(docs, table(spark, sf_dir, "labels"))


def feistel_sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of the global shuffle."""
    return sharding.feistel_shards(docs, ["doc_id"])


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mixing_to_target_weights", mixing_to_target_weights),
    ("feistel_sharding", feistel_sharding),
]

#: SimHash components, the latent space and the fitted classifier are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

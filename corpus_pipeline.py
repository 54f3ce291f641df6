"""The corpus pipeline: stages over documents, each on what the one before it kept.

A stage takes the session, its documents and the folder of the tables.  All but
the last return the columns of documents; the last adds virtual_slot and shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bankspark.llm import decontamination, mixing, ngram_join, quality_rules, sharding
from bankspark.sources.scratch import store


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one of the least id stays."""
    return ngram_join.one_per_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document stands there as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def place_in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.sharded_documents(docs)


STAGES = [
    ("quality rules", quality),
    ("n-gram join", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", place_in_shards),
]
#: SQL has no words for the rebalanced slot map; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir))
    return docs


pipeline = run

"""The corpus pipeline: quality rules, near-duplicates, decontamination, mixing, sharding.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept; ``run``
stores each result as Parquet in the shared folder and reads it again for the next one.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunetable.llm import fair_mix, line_quality, simhash_anchors, spaced_seeds, virtual_slots
from tunetable.session import settle

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
SHARDS = 16


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule go; the others lose the lines that are boilerplate of their source."""
    kept = line_quality.clean_documents(docs.select(*COLUMNS))
    return kept.withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: that of the smallest id."""
    return simhash_anchors.one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with a benchmark item go."""
    return spaced_seeds.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights, in the order of service: a document comes as often as the mix takes it."""
    return fair_mix.mixed_documents(docs, "doc_id", "text", "source")


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their ``size``, ``virtual_slot``, ``shard`` and ``map_version``."""
    return virtual_slots.sharded(docs, SHARDS)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# Fingerprints and their components have no SQL form; tests/llm compares the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs

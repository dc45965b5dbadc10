"""A corpus pipeline of five operators, each stage on what the one before kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from relcheck.llm import decontaminate, mixing, near_dedup, quality, sharding
from relcheck.session import scratch_path
from relcheck.sources.tables import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the page and host rules keep."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicate texts, the smallest id;
    different texts under one id stay, rows without id are compared as well."""
    return near_dedup.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages cut out; documents that are mostly benchmark go."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"), counts=("n_chars",))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks for, 0 to 3 times."""
    return mixing.mixed(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents, shard (0 to 23, near equal bytes) and slot.
    Columns of these two names that the input has are replaced."""
    own = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    return sharding.shard_by_bytes(docs, 24, carry=own).select("row.*", "shard", "slot")


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("source mixing", source_mixing),
    ("sharding", sharding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared
    folder and read back as the next stage's input."""
    docs, run_id = table(spark, sf_dir, "documents"), uuid.uuid4().hex
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = scratch_path(spark, f"relcheck-pipeline-{run_id}/{i}")
            docs.write.parquet(path)
            docs = spark.read.schema(docs.schema).parquet(path)
    return docs


#: Cutting spans out of texts cannot be said in SQL; the stages are tested
#: against brute-force versions.
ORACLE_SQL = None

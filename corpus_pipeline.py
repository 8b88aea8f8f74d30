"""The corpus pipeline: documents to shards in five stages, each of which calls one operator of dyelake.llm.

Every stage works on all that the stage before kept; its rows are written as Parquet and read again as the next one's
documents, so a lost executor costs part of one stage.
Every stage takes nulls in any column, empty and very long texts, repeated rows, empty tables and other columns of any name; what
it does with each is said at its function in dyelake.llm.stages.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from dyelake.functions.storage import remove, scratch, shared_dir
from dyelake.llm import stages
from dyelake.sources.tables import table

SHARDS = 40


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents in no known language go."""
    return stages.known_language(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: one document of each group stays."""
    return stages.one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with a benchmark passage go."""
    return stages.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights: documents stay, go or come twice as their source's target asks."""
    return stages.to_target_weights(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sharding: each row with its shard of near-equal bytes, and its slot there."""
    return stages.sharded(docs, SHARDS)


STAGES = [
    ("language ID", language),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources", mixing),
    ("sharding", sharding),
]

#: SuperMinHash groups by hashes have no form in SQL; tests/llm/test_stages.py compares run() with a plain form of all five stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``. What a stage wrote on its way goes once its rows are written, and those go once the next stage's are."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        path = f"{shared_dir(spark)}/dyelake-stage-{uuid.uuid4().hex}"
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        remove(spark, *([before] if before else []))
        before = path
    return docs

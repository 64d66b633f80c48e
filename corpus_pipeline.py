"""A training corpus from ``documents``: five stages, each an operator whose decisions take effect.

Toxic documents go, one document of each near-duplicate group stays, documents that hold benchmark items go, sources
are mixed to their targets, and the mix is shuffled into shards. Every stage reads the table that the one before wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spinneret.llm import decontamination, mixing, near_dups, sharding, toxicity
from spinneret.llm.common import table
from spinneret.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dups.without_near_duplicates(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document that the mix takes twice is two rows. The order of training is the order of the rows."""
    return mixing.mix_table(docs).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds ``shard`` and ``slot``."""
    return sharding.shard_table(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: SQL cannot express the classifier; the tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

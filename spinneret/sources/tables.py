"""Readers: page snapshots, plain texts, fetch logs, seed lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table. One with fewer splits than the cluster has cores is spread out before the parsing starts."""
    table = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    return table.repartition(cores) if table.rdd.getNumPartitions() < cores else table


def split_seeds(lists: DataFrame, column: str) -> DataFrame:
    """``(url)``: the parts of comma-separated seed lists, trimmed, blanks dropped, duplicates kept."""
    parts = lists.select(F.explode(F.split(column, ",")).alias("part"))
    trimmed = F.regexp_replace("part", r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    return parts.select(trimmed.alias("url")).where(F.col("url") != "")


def seed_urls(spark: SparkSession, text: str | None) -> DataFrame:
    """Seeds from one string; a missing or blank one is an error."""
    if text is None or not text.strip():
        raise ValueError("a comma-separated list of seed URLs is needed")
    return split_seeds(spark.createDataFrame([(text,)], "seeds string"), "seeds")


def fetch(frontier: DataFrame, pages: DataFrame) -> DataFrame:
    """Look the frontier's URLs up in the page snapshot; ``page_id`` is NULL where the fetch fails."""
    found = pages.select("url", "page_id")
    return frontier.join(found, "url", "left").select("url", "page_id", F.col("page_id").isNotNull().alias("fetched"))


def fetch_log(events: DataFrame, url: str, ok: Column, ts: str = "ts", order: str = "event_id") -> DataFrame:
    """``(url, ts, seq, ok)`` from any event table; ``seq`` orders attempts of the same time."""
    return events.select(
        F.col(url).cast("string").alias("url"), F.col(ts).alias("ts"), F.col(order).alias("seq"), ok.alias("ok")
    )

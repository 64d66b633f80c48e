"""Shared pieces: table access, row numbers of a scan, and connected components."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spinneret.session import cut_lineage

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
ROW = "_row"
# Bits of a row's place in its file; the file's number stands above them.
_INDEX_BITS = 40
#: Links that a task of a contraction is meant for.
TASK_LINKS = 50_000

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as it is stored; splits follow the files, nothing is shuffled.

    The Python workers import this package, so its folder joins their path; with ``--py-files`` it is there already.
    """
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_row(scan: DataFrame) -> DataFrame:
    """Number the rows of a table scan by their file and their place in it.

    The number does not depend on how the files are cut into splits, which may differ from job to job, as when executors
    come or go. It holds for scans of files only. Files are numbered in the order of their names: one row each, broadcast.
    """
    place = scan.metadataColumn("_metadata")
    told = scan.select("*", place.getField("file_path").alias("_file"), place.getField("row_index").alias("_index"))
    order = F.row_number().over(Window.orderBy("_file")) - 1
    files = told.select("_file").distinct().select("_file", order.cast("bigint").alias("_number"))
    numbered = told.join(F.broadcast(files), "_file")
    number = F.shiftleft("_number", _INDEX_BITS).bitwiseOR(F.col("_index"))
    return numbered.select(*scan.columns, number.alias(ROW))


def packed(scan: DataFrame) -> DataFrame:
    """``(_row, doc)``: the rows of a table scan as one struct column, so that no column's name can clash with others."""
    return with_row(scan.select(F.struct(*[scan[c] for c in scan.columns]).alias("doc")))


def components(links: DataFrame) -> DataFrame:
    """``(id, component)``: the least id that each linked id reaches, from undirected ``links(a, b)`` of longs.

    Alternating star contraction: every id hangs its larger neighbours, then its smaller ones, on its least neighbour,
    until nothing changes; the rounds grow with the logarithm of the longest path. A hub's least neighbour is found by
    a map-side combined minimum, and its links stay rows of a join, so no neighbour list is ever one value. Each round
    is checkpointed. Ids without a link are not in the result.

    A round writes a few files for each of its tasks, so it has no more tasks than its links need, whatever the number of
    shuffle partitions.
    """
    edges = cut_lineage(_least_first(links.select(F.col("a").cast("bigint"), F.col("b").cast("bigint"))))
    now, before = (edges.count(),), None
    while True:
        # Each half of a round makes at most twice the links it was given.
        n_tasks = max(1, -(-now[0] // TASK_LINKS))
        edges = edges.coalesce(n_tasks)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).coalesce(n_tasks)
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        larger = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b")
        edges = cut_lineage(_least_first(larger.coalesce(n_tasks)).coalesce(n_tasks))
        # What is left are links from a smaller id a to a larger one b: hang all smaller neighbours of b on the least.
        least = edges.groupBy("b").agg(F.min("a").alias("m"))
        smaller = edges.join(least, "b").select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b"))
        edges = cut_lineage(_least_first(smaller.coalesce(n_tasks)).coalesce(n_tasks))
        # The edges are distinct, so equal counts and equal sums of hashes mean that the round changed nothing.
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    roots = edges.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct().coalesce(n_tasks)
    return edges.select(F.col("b").alias("id"), F.col("a").alias("component")).unionByName(roots)


def _least_first(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def id_digest(seed: int) -> Column:
    """The hex sha256 of ``seed:doc_id``, from which draws for a document are read; a null doc_id is the empty string."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)


def digest_group(digest: Column, n: int) -> Column:
    """The ``n``-th group (0-based) of eight hex digits as an unsigned integer."""
    return F.conv(F.substring(digest, 8 * n + 1, 8), 16, 10).cast("bigint")

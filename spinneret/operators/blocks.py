"""Token blocks: a sorted table in ranges that are partitions, and the few of them that a look-up reads.

A table in token order is written range by range, each range into a partition of its own. What is kept of a block is its
number and the head of its first and its last token. Terms are put in order with these heads, once, and each gets the
blocks that may hold it; a join on the partition column then reads those and no others, whatever the number of terms.
A hot token spans several blocks, so no block grows with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinneret.operators.ordering import in_ranges, scan_max
from spinneret.session import cut_lineage, has_at_most

#: Rows that a block is meant for, and most blocks of a table; beyond them blocks grow.
BLOCK_ROWS, MOST_BLOCKS = 1_000_000, 100_000
#: Blocks of fewer than ``BLOCK_ROWS`` rows that a table may have; each costs a task, files, and samples on the driver.
SMALL_BLOCKS = 64
#: Characters of a token that blocks are told apart by; equal heads only add blocks to a look-up.
HEAD = 64
# Most terms that are broadcast against the dictionary or the postings.
BROADCAST_TERMS = 100_000
# Numbers of the blocks of one segment; the segment's place in the list stands above them.
_SEGMENT_BITS = 32


def number_of_blocks(n_rows: int, block_rows: int) -> int:
    """Blocks of ``block_rows`` rows. Smaller ones than ``BLOCK_ROWS`` grow up to it once there are ``SMALL_BLOCKS`` of them."""
    n_blocks = -(-n_rows // block_rows)
    if block_rows < BLOCK_ROWS:
        n_blocks = min(n_blocks, max(SMALL_BLOCKS, -(-n_rows // BLOCK_ROWS)))
    return max(1, min(MOST_BLOCKS, n_blocks))


def write_blocks(df: DataFrame, path: str, *keys: str, n_blocks: int, **options: str) -> None:
    """Write ``df`` in ranges of ``keys``, each range as the partition ``block``, in order."""
    ranged = df.repartitionByRange(n_blocks, *keys).withColumn("block", F.spark_partition_id().cast("bigint"))
    ranged.sortWithinPartitions("block", *keys).write.options(**options).partitionBy("block").parquet(path)


def block_edges(blocked: DataFrame) -> DataFrame:
    """``(block, first, last)`` of a table with ``block`` and ``token``; reads nothing else of it."""
    head = F.substring("token", 1, HEAD)
    return blocked.groupBy("block").agg(F.min(head).alias("first"), F.max(head).alias("last"))


def find_blocks(terms: DataFrame, edges: DataFrame) -> DataFrame:
    """``(segment, block, token)``: the blocks that may hold each of ``(segment, term)``, out of ``(segment, block, first, last)``.

    ``segment`` is a number. Blocks rise with the tokens, so the last block that starts at or before a term, and the last
    one that ends before it, are running maxima over terms and edges in one order. A term between two blocks has none.
    """
    number = F.shiftleft("segment", _SEGMENT_BITS) + F.col("block")
    none = F.lit(None).cast("bigint")
    starts = edges.select("segment", F.col("first").alias("key"), F.lit(0).alias("kind"), number.alias("starts"), none.alias("ends"))
    ends = edges.select("segment", F.col("last").alias("key"), F.lit(2).alias("kind"), none.alias("starts"), number.alias("ends"))
    head = F.substring("term", 1, HEAD).alias("key")
    asked = terms.select("segment", head, F.lit(1).alias("kind"), none.alias("starts"), none.alias("ends"), F.col("term").alias("token"))
    events = starts.unionByName(ends).withColumn("token", F.lit(None).cast("string")).unionByName(asked)
    ranged = in_ranges(events, "segment", "key", "kind", "token")
    placed = scan_max(scan_max(ranged, "starts", out="high"), "ends", out="low").where("kind = 1")
    bottom = F.shiftleft("segment", _SEGMENT_BITS)
    low = F.greatest(F.coalesce(F.col("low") + 1, bottom), bottom)
    held = placed.select("segment", "token", low.alias("low"), "high").where(F.col("low") <= F.col("high"))
    spread = held.select("segment", "token", F.explode(F.sequence("low", "high")).alias("number"))
    return spread.select("segment", (F.col("number") - F.shiftleft("segment", _SEGMENT_BITS)).alias("block"), "token")


def rows_of(blocked: DataFrame, found: DataFrame, *keys: str) -> DataFrame:
    """The rows of a table in partitions ``keys`` whose token is in one of its places ``found(*keys, token)``.

    A checked number of places is broadcast, and the scan leaves out all partitions but theirs at run time. More places
    are joined by a shuffle, after the scan was cut down to their partitions, of which there are few enough to broadcast.
    """
    # Spark prunes by a side that a filter makes selective.
    found = cut_lineage(found).where("block >= 0")
    if has_at_most(found, BROADCAST_TERMS):
        return blocked.join(F.broadcast(found), [*keys, "token"])
    places = found.select(*keys).distinct()
    near = F.broadcast(places) if has_at_most(places, MOST_BLOCKS) else places
    return blocked.join(near, list(keys), "left_semi").join(found, [*keys, "token"])

"""Segment layouts as columns: sizes, gaps, offsets and slots of the exported postings and dictionaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spinneret.functions.varint import varint_width
from spinneret.operators.ordering import dense_rank, offsets
from spinneret.operators.postings import BLOCK, doc_frequency

# --- Fixed values of the layouts ------------------------------------------------------------------------------------
INT_BYTES = 4
TOKEN_BYTES = 64
OFFSET_BYTES = 8
# --------------------------------------------------------------------------------------------------------------------


def fixed_layout(postings: DataFrame) -> DataFrame:
    """``(token, n_docs, n_bytes, offset)``: a 4-byte count and 4 bytes per id, tokens in order."""
    sizes = doc_frequency(postings).withColumn("n_bytes", F.lit(INT_BYTES) + F.lit(INT_BYTES) * F.col("n_docs"))
    return offsets(sizes, "token", size="n_bytes", out="offset")


def posting_gaps(postings: DataFrame) -> DataFrame:
    """``(token, doc_id, gap)``: difference to the token's previous id, the id itself for its first.

    The window covers one block of the id space, so its length is bounded for any token. The first id of a block takes
    the last one of the token's block before, out of a table with one row per block.
    """
    blocked = postings.select("token", "doc_id", F.expr(f"doc_id div {BLOCK}").alias("block"))
    by_block = Window.partitionBy("token", "block").orderBy("doc_id")
    last_ids = blocked.groupBy("token", "block").agg(F.max("doc_id").alias("last_id"))
    before = last_ids.select(
        "token", "block", F.lag("last_id").over(Window.partitionBy("token").orderBy("block")).alias("before")
    )
    inside = blocked.withColumn("previous", F.lag("doc_id").over(by_block)).join(before, ["token", "block"])
    previous = F.coalesce("previous", "before", F.lit(0))
    return inside.select("token", "doc_id", (F.col("doc_id") - previous).alias("gap"))


def compact_layout(postings: DataFrame) -> DataFrame:
    """``(token, n_docs, n_bytes, offset)``: varint count, then the gaps as varints, tokens in order.

    The gaps inside a block add up where the block's window already put them; only one row per block goes on, with its
    first and last id, to size the gaps between blocks.
    """
    blocked = postings.select("token", "doc_id", F.expr(f"doc_id div {BLOCK}").alias("block"))
    by_block = Window.partitionBy("token", "block").orderBy("doc_id")
    gaps = blocked.withColumn("gap", F.col("doc_id") - F.lag("doc_id").over(by_block))
    blocks = gaps.groupBy("token", "block").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.coalesce(F.sum(varint_width(F.col("gap"))), F.lit(0)).alias("inside"),
        F.min("doc_id").alias("first_id"),
        F.max("doc_id").alias("last_id"),
    )
    before = F.lag("last_id", 1, 0).over(Window.partitionBy("token").orderBy("block"))
    sized = blocks.withColumn("between", varint_width(F.col("first_id") - before))
    sizes = sized.groupBy("token").agg(F.sum("n_docs").alias("n_docs"), F.sum(F.col("inside") + F.col("between")).alias("gap_bytes"))
    total = (varint_width(F.col("n_docs")) + F.col("gap_bytes")).alias("n_bytes")
    return offsets(sizes.select("token", "n_docs", total), "token", size="n_bytes", out="offset")


def layout(postings: DataFrame, compact: bool) -> DataFrame:
    return compact_layout(postings) if compact else fixed_layout(postings)


def fixed_dictionary(token_dict: DataFrame, width: int = TOKEN_BYTES) -> DataFrame:
    """``(slot, token, offset, record_at)``: records of one width in token order. Longer tokens are left out."""
    fitting = token_dict.where(F.octet_length("token") <= width).select("token", "offset")
    record_at = (F.col("slot") * (width + OFFSET_BYTES)).alias("record_at")
    return dense_rank(fitting, "token", out="slot").select("slot", "token", "offset", record_at)


def too_long_tokens(token_dict: DataFrame, width: int = TOKEN_BYTES) -> DataFrame:
    """``(token, token_bytes)`` of the tokens that :func:`fixed_dictionary` leaves out."""
    size = F.octet_length("token")
    return token_dict.where(size > width).select("token", size.cast("bigint").alias("token_bytes"))

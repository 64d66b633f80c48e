"""Index segments: metadata, search over several, merging."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinneret.operators.blocks import find_blocks, rows_of
from spinneret.operators.ordering import dense_rank
from spinneret.session import cut_lineage

# Document ids that are broadcast in a merge, of 24 bytes each and the segment's name.
SMALL_MAPPING = 100_000


def segment_meta(token_dict: DataFrame, doc_table: DataFrame, segment_id: str) -> DataFrame:
    """One row ``(segment_id, token_count, doc_count, first_token, last_token)``; the caller adds the time of writing."""
    tokens = token_dict.select("token", F.lit(0).alias("is_doc"))
    rows = tokens.unionByName(doc_table.select(F.lit(None).cast("string").alias("token"), F.lit(1).alias("is_doc")))
    return rows.agg(
        F.lit(segment_id).alias("segment_id"),
        F.count("token").alias("token_count"),
        F.coalesce(F.sum("is_doc"), F.lit(0)).alias("doc_count"),
        F.min("token").alias("first_token"),
        F.max("token").alias("last_token"),
    )


def asked_segments(terms: DataFrame, meta: DataFrame) -> DataFrame:
    """``(segment, segment_id, term)``: for each ``(term)`` the segments whose first and last token it lies between.

    The metadata, a row for each segment folder, is read first and becomes one constant array; ``segment`` is a segment's
    place in it.
    """
    listed = meta.where("first_token IS NOT NULL").select("segment_id", "first_token", "last_token").orderBy("segment_id").collect()
    if not listed:
        return terms.select(F.lit(0).cast("bigint").alias("segment"), F.lit("").alias("segment_id"), "term").where("false")
    spans = F.array(*[F.struct(*[F.lit(row[c]).alias(c) for c in ("segment_id", "first_token", "last_token")]) for row in listed])
    each = terms.select("term", F.posexplode(spans).alias("segment", "s"))
    inside = each.where(F.col("term").between(F.col("s.first_token"), F.col("s.last_token")))
    return inside.select(F.col("segment").cast("bigint").alias("segment"), "s.segment_id", "term")


def search_segments(terms: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """``(term, segment_id, url)``: the documents of each ``(term)`` in every segment, out of the tables of a folder.

    The metadata says which segments may hold a term: no others are scanned. Of those, the edges of their blocks say which
    blocks to read.
    """
    asked = cut_lineage(asked_segments(terms, tables["segment_meta"]))
    names = asked.select("segment", "segment_id").distinct()
    # At most a name for each segment folder.
    chosen = F.col("segment_id").isin([row["segment_id"] for row in names.select("segment_id").collect()])
    edges = tables["posting_edges"].where(chosen).join(F.broadcast(names), "segment_id").select("segment", "block", "first", "last")
    found = find_blocks(asked.select("segment", "term"), edges).join(F.broadcast(names), "segment")
    hits = rows_of(tables["postings"].where(chosen), found.select("segment_id", "block", "token"), "segment_id", "block")
    listed = hits.join(tables["doc_table"].where(chosen).select("segment_id", "doc_id", "url"), ["segment_id", "doc_id"])
    return listed.select(F.col("token").alias("term"), "segment_id", "url")


def merge_segments(doc_tables: DataFrame, postings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(doc_table, postings)`` of several segments as one, the postings in order of token and id.

    Takes ``(segment_id, doc_id, url)`` and ``(segment_id, token, doc_id)``. A URL in several segments becomes one
    document with the union of their tokens. Ids are ranks of the URLs, taken once. The renumbered postings are cut into
    common ranges of (token, id); equal ones meet in a range, and a range is deduplicated and sorted where it lies.
    """
    merged = cut_lineage(dense_rank(doc_tables.select("url").distinct(), "url", out="new_id"))
    mapping = cut_lineage(doc_tables.select("segment_id", "doc_id", "url").join(merged, "url").select("segment_id", "doc_id", "new_id"))
    near = F.broadcast(mapping) if mapping.count() <= SMALL_MAPPING else mapping
    remapped = postings.select("segment_id", "token", "doc_id").join(near, ["segment_id", "doc_id"])
    ranged = remapped.select("token", F.col("new_id").alias("doc_id")).repartitionByRange("token", "doc_id")
    ordered = ranged.dropDuplicates(["token", "doc_id"]).sortWithinPartitions("token", "doc_id")
    return merged.select(F.col("new_id").alias("doc_id"), "url"), ordered

"""The inverted index: one row per (token, document), and array blocks derived from it.

There is no stop-word list, so a common token is in nearly every document. One row per posting keeps such a token
splittable; arrays hold one block of the id space each and so have a fixed greatest length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinneret.operators.terms import distinct_stems, text_token_arrays, token_arrays

# Ids per block: the greatest length of an array and of a gap window.
BLOCK = 1 << 16


def inverted_index(pages: DataFrame, doc_table: DataFrame) -> DataFrame:
    """``(token, doc_id)`` for the pages that ``doc_table`` lists.

    Pages are parsed where they are read; the join on the unique ``page_id`` then moves token arrays, not HTML.
    """
    return index_tokens(token_arrays(pages), doc_table)


def index_tokens(token_lists: DataFrame, doc_table: DataFrame) -> DataFrame:
    """``(token, doc_id)`` of pages that are ``(page_id, tokens)`` already."""
    words = token_lists.join(doc_table.select("page_id", "doc_id"), "page_id").select("doc_id", "tokens")
    return distinct_stems(words, "doc_id").select("token", "doc_id")


def text_index(documents: DataFrame) -> DataFrame:
    """``(token, doc_id)`` over plain-text documents that carry their own id."""
    return distinct_stems(text_token_arrays(documents, "doc_id"), "doc_id").select("token", "doc_id")


def doc_frequency(postings: DataFrame) -> DataFrame:
    """``(token, n_docs)``."""
    return postings.groupBy("token").agg(F.count(F.lit(1)).alias("n_docs"))


def posting_blocks(postings: DataFrame) -> DataFrame:
    """``(token, block, n_docs, doc_ids)``: ascending ids, at most ``BLOCK`` per row."""
    return (
        postings.withColumn("block", F.expr(f"doc_id div {BLOCK}"))
        .groupBy("token", "block")
        .agg(F.sort_array(F.collect_list("doc_id")).alias("doc_ids"))
        .select("token", "block", F.size("doc_ids").cast("bigint").alias("n_docs"), "doc_ids")
    )

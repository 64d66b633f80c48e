"""The document dictionary: dense ids, look-ups in both directions, listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinneret.operators.ordering import dense_rank


def first_fetches(pages: DataFrame) -> DataFrame:
    """``(url, page_id)``: a URL is indexed once, from its first page row. Reads no HTML."""
    return pages.where(F.col("url").isNotNull()).groupBy("url").agg(F.min("page_id").alias("page_id"))


def build_doc_table(pages: DataFrame) -> DataFrame:
    """``(doc_id, url, page_id)`` with ids 0..n-1 in URL order; pages without any token have an id too."""
    return dense_rank(first_fetches(pages), "url", out="doc_id").select("doc_id", "url", "page_id")


def extend_doc_table(doc_table: DataFrame, pages: DataFrame, next_id: int) -> DataFrame:
    """Rows for the URLs of ``pages`` that ``doc_table`` lacks, numbered from ``next_id``; known URLs keep their id."""
    new = first_fetches(pages).join(doc_table.select("url"), "url", "left_anti")
    numbered = dense_rank(new, "url", out="_rank")
    return numbered.select((F.col("_rank") + F.lit(next_id)).alias("doc_id"), "url", "page_id")


def ids_of_urls(doc_table: DataFrame, urls: DataFrame) -> DataFrame:
    """``(url, doc_id)`` for each asked URL, NULL where unknown."""
    return urls.select("url").join(doc_table.select("url", "doc_id"), "url", "left")


def urls_of_ids(doc_table: DataFrame, ids: DataFrame) -> DataFrame:
    """``(doc_id, url)`` for each asked id, NULL where out of range."""
    return ids.select("doc_id").join(doc_table.select("doc_id", "url"), "doc_id", "left")


def list_documents(doc_table: DataFrame) -> DataFrame:
    """All documents in id order; ordered by range partitioning, not in one task."""
    return doc_table.select("doc_id", "url").orderBy("doc_id")


def count_documents(doc_table: DataFrame) -> DataFrame:
    return doc_table.agg(F.count(F.lit(1)).alias("n_docs"))


def indexed_documents(doc_table: DataFrame, postings: DataFrame) -> DataFrame:
    """Documents that have at least one posting. Ids are made distinct map-side before the shuffle."""
    return doc_table.join(postings.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "url")

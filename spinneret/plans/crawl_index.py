"""Whole jobs: crawl a snapshot and index what it reaches; build and write an index."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame

from spinneret.operators.blocks import BLOCK_ROWS
from spinneret.operators.documents import build_doc_table
from spinneret.operators.postings import inverted_index
from spinneret.operators.traversal import crawl
from spinneret.session import cut_lineage
from spinneret.sources.index_files import read_segment, write_segment


def build_index(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(doc_table, postings)`` of a page snapshot."""
    doc_table = build_doc_table(pages)
    return doc_table, inverted_index(pages, doc_table)


def crawl_and_index(pages: DataFrame, seeds: DataFrame, max_hops: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(doc_table, postings)`` of the pages that can be reached from the seeds.

    What was reached narrows the document table, whose ids then select the parsed pages: no HTML goes through a shuffle.
    """
    fetched = crawl(pages, seeds, max_hops).where("state = 'fetched'").select("url")
    doc_table = build_doc_table(pages.select("url", "page_id").join(fetched, "url", "left_semi"))
    return doc_table, inverted_index(pages, doc_table)


def publish(
    pages: DataFrame, folder: str, segment_id: str, compact: bool = True, block_rows: int = BLOCK_ROWS
) -> dict[str, DataFrame]:
    """Build the index of a snapshot, write it as one segment and open that segment."""
    doc_table, postings = build_index(pages)
    now = datetime.now(timezone.utc)
    base = write_segment(cut_lineage(postings), doc_table, folder, segment_id, compact, now, block_rows)
    return read_segment(pages.sparkSession, base, segment_id)

"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from spinneret.plans.catalog import all_queries, segment, written_segments  # noqa: E402
from spinneret.session import local_session  # noqa: E402

HEADLINE = [
    "page_text", "page_tokens", "resolved_links", "stemmed_vocab", "doc_table", "inverted_index", "document_index",
    "doc_frequency", "crawl_reachable", "crawl_index", "crawl_outcome", "crawl_retry", "retry_ledger", "postings_compact",
    "document_compact", "token_trie", "token_automaton", "token_lookup", "segment_search", "segment_merge", "search_urls", "sampled_lookup",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    # One untimed query starts the JVM's code paths and the table readers.
    spark.read.parquet(f"{sf_dir}/pages.parquet").selectExpr("count(html)").collect()
    seconds = {}
    started = time.time()
    segment(spark, sf_dir)
    seconds["segment_write"] = round(time.time() - started, 3)
    for name in HEADLINE:
        if name == "segment_search":
            # Four more segments; the searches that follow only read them.
            started = time.time()
            written_segments(spark, sf_dir)
            seconds["segments_write"] = round(time.time() - started, 3)
        started = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 3)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total query time", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()

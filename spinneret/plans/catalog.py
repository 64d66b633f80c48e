"""The checked queries: each runs one operator over the whole given tables and returns flat columns."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spinneret.operators import documents, layout, links, ordering, postings, prefixes, search, segments, terms, traversal
from spinneret.plans.crawl_index import crawl_and_index, publish
from spinneret.session import cut_lineage, scratch_path
from spinneret.sources.index_files import SAMPLE_EVERY, read_segments, text_lines, write_index, write_segment
from spinneret.sources.tables import fetch, fetch_log, read_table, split_seeds
from spinneret.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

N_SEGMENTS = 4
# Rows of a token block; small, so that the small tables have several.
BLOCK_ROWS = 1 << 15
# Batches that a table is fed to a stream in.
N_BATCHES = 3

_published: dict[tuple[str, str], dict[str, DataFrame]] = {}


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/pages.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/documents.parquet")


def _terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.query_terms(read_table(spark, f"{sf_dir}/benchmark.parquet"))


def segment(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The index of ``pages`` as a written segment. It is written once per session; the read side opens it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _published:
        _published[key] = publish(_pages(spark, sf_dir), scratch_path(spark, "index"), "pages", block_rows=BLOCK_ROWS)
    return _published[key]


def _urls(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).alias("url"))


# --- sources, HTML, links -------------------------------------------------------------------------------------------
def seed_urls(spark, sf_dir):
    lists = _pages(spark, sf_dir).select(
        F.concat(F.lit("  "), F.col("url"), F.lit(" , ,,"), F.col("url"), F.lit("#again,  ")).alias("seeds")
    )
    return split_seeds(lists, "seeds")


def _queue(spark, sf_dir):
    """Every page URL and every link target, with duplicates, as they would wait in the frontier."""
    pages = _pages(spark, sf_dir)
    return _urls(pages, "url").unionByName(_urls(links.resolved_links(pages), "dst_url"))


def _visited(spark, sf_dir):
    """Page URLs and the target of each page's first link."""
    pages = _pages(spark, sf_dir)
    first = links.resolved_links(pages).where("position = 0")
    return _urls(pages, "url").unionByName(_urls(first, "dst_url")).distinct()


def fetch_frontier(spark, sf_dir):
    return fetch(_queue(spark, sf_dir).distinct(), documents.first_fetches(_pages(spark, sf_dir)))


def page_links(spark, sf_dir):
    found = links.page_links(_pages(spark, sf_dir))
    return found.select("page_id", F.col("position").cast("bigint").alias("position"), "href")


def resolved_links(spark, sf_dir):
    return resolved_links_of(_pages(spark, sf_dir))


def resolved_links_of(pages):
    found = links.resolved_links(pages)
    return found.select("page_id", F.col("position").cast("bigint").alias("position"), "dst_url")


def href_cases(spark, sf_dir):
    """The same links from pages whose root-relative ones are written with line breaks, tabs and entities."""
    written = F.regexp_replace("html", '(?i)href="/', 'href="\n\t &#x2F;')
    return resolved_links_of(_pages(spark, sf_dir).withColumn("html", F.regexp_replace(written, "(?i)</a>", "</a><a href=' &#109;ailto:q@r.s\t'></a>")))


def unvisited_links(spark, sf_dir):
    left = links.unvisited(links.resolved_links(_pages(spark, sf_dir)), _visited(spark, sf_dir))
    return left.select("page_id", F.col("position").cast("bigint").alias("position"), "dst_url")


def visited_dedup(spark, sf_dir):
    return traversal.dequeue_unvisited(_queue(spark, sf_dir), _visited(spark, sf_dir))


# --- text and terms -------------------------------------------------------------------------------------------------
def page_text(spark, sf_dir):
    """Runs of blanks are folded, since their number has no meaning to any later step."""
    text = terms.page_text(_pages(spark, sf_dir))
    return text.select("page_id", F.trim(F.regexp_replace("text", " +", " ")).alias("text"))


def page_tokens(spark, sf_dir):
    found = terms.page_tokens(_pages(spark, sf_dir))
    return found.select("page_id", F.col("position").cast("bigint").alias("position"), "token")


def stemmed_vocab(spark, sf_dir):
    return terms.stemmed_vocabulary(terms.page_tokens(_pages(spark, sf_dir)))


def doc_terms(spark, sf_dir):
    return terms.doc_terms(_pages(spark, sf_dir))


# --- index and document dictionary ----------------------------------------------------------------------------------
def doc_table(spark, sf_dir):
    return documents.build_doc_table(_pages(spark, sf_dir)).select("doc_id", "url")


def doc_table_extend(spark, sf_dir):
    """Ids of the even pages, extended by all pages: known URLs keep their ids, the others follow."""
    pages = _pages(spark, sf_dir)
    known = cut_lineage(documents.build_doc_table(pages.where("page_id % 2 = 0")))
    more = documents.extend_doc_table(known, pages, known.count())
    return known.select("doc_id", "url").unionByName(more.select("doc_id", "url"))


def inverted_index(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    return postings.inverted_index(pages, documents.build_doc_table(pages))


def document_index(spark, sf_dir):
    return postings.text_index(_documents(spark, sf_dir))


def doc_frequency(spark, sf_dir):
    return postings.doc_frequency(segment(spark, sf_dir)["postings"])


def doc_lookup(spark, sf_dir):
    docs = segment(spark, sf_dir)["doc_table"]
    by_url = documents.ids_of_urls(docs, _queue(spark, sf_dir).distinct())
    probes = read_table(spark, f"{sf_dir}/documents.parquet").select((F.col("doc_id") - 5).alias("doc_id")).distinct()
    by_id = documents.urls_of_ids(docs, probes)
    return by_url.select(F.lit("url").alias("asked"), "url", "doc_id").unionByName(
        by_id.select(F.lit("id").alias("asked"), "url", "doc_id")
    )


def doc_listing(spark, sf_dir):
    return documents.list_documents(segment(spark, sf_dir)["doc_table"])


def doc_count(spark, sf_dir):
    return documents.count_documents(segment(spark, sf_dir)["doc_table"])


def indexed_urls(spark, sf_dir):
    written = segment(spark, sf_dir)
    return documents.indexed_documents(written["doc_table"], written["postings"])


# --- traversal ------------------------------------------------------------------------------------------------------
def _graph(spark, sf_dir):
    """A cyclic graph over the page ids, since no link in the snapshot leads to another page of it.

    Page i links to 2i+1 and 2i+2, and every fifth page also to (7i+3) mod n.
    """
    ids = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id")
    n = ids.count()
    i = F.col("page_id")
    wrapped = F.when(i % 5 == 0, (i * 7 + 3) % n)
    pairs = ids.select(i.alias("src"), F.explode(F.array(i * 2 + 1, i * 2 + 2, wrapped)).alias("dst"))
    inside = pairs.where(F.col("dst") < n)
    return inside.select(F.col("src").cast("string").alias("src_url"), F.col("dst").cast("string").alias("dst_url"))


def _linked_pages(spark, sf_dir):
    """The pages with tags for those links put at the start of their bodies, without text of their own."""
    pages = _pages(spark, sf_dir)
    names = pages.select(F.col("page_id").cast("string").alias("dst_url"), F.col("url").alias("target"))
    tags = _graph(spark, sf_dir).join(names, "dst_url").groupBy(F.col("src_url").cast("bigint").alias("page_id")).agg(
        F.array_join(F.collect_list(F.concat(F.lit('<a href="'), F.col("target"), F.lit('"></a>'))), "").alias("tags")
    )
    joined = pages.join(tags, "page_id", "left")
    parts = F.split("html", "(?i)(?<=<body>)", 2)
    html = F.when(F.size(parts) == 2, F.concat(parts[0], F.coalesce("tags", F.lit("")), parts[1])).otherwise(F.col("html"))
    return joined.select("page_id", "url", html.alias("html"))


def _first_url(spark, sf_dir):
    return _urls(_pages(spark, sf_dir).where("page_id = 1"), "url")


def crawl_reachable(spark, sf_dir):
    """Pages that a crawl of the linked pages fetches from one seed, with the number of hops."""
    seen = traversal.crawl(_linked_pages(spark, sf_dir), _first_url(spark, sf_dir)).where("state = 'fetched'")
    return seen.select("url", F.col("hop").cast("bigint").alias("hop"))


def crawl_index(spark, sf_dir):
    """Crawl the linked pages from one seed and index what is reached."""
    docs, rows = crawl_and_index(_linked_pages(spark, sf_dir), _first_url(spark, sf_dir))
    return rows.join(docs.select("doc_id", "url"), "doc_id").select("token", "doc_id", "url")


def crawl_outcome(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    seen = traversal.crawl(pages, _urls(pages, "url"))
    return seen.groupBy("state", F.col("hop").cast("bigint").alias("hop")).agg(F.count(F.lit(1)).alias("n_urls"))


def _page_attempts(spark, sf_dir):
    """A fetch log of the pages: event i is an attempt at page i mod n, and fails if it is an error or a view."""
    events = read_table(spark, f"{sf_dir}/events.parquet")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", F.col("url").alias("page_url"))
    ids = events.withColumn("page_id", F.col("event_id") % pages.count())
    return fetch_log(ids.join(pages, "page_id"), "page_url", ~F.col("event_type").isin("error", "view"))


def crawl_retry(spark, sf_dir):
    """The crawl of the linked pages where fetches fail: when each URL is queued, how often it is tried, what becomes of it."""
    seen = traversal.crawl(_linked_pages(spark, sf_dir), _first_url(spark, sf_dir), log=_page_attempts(spark, sf_dir))
    counts = [F.col(c).cast("bigint").alias(c) for c in ("hop", "attempts")]
    return seen.select("url", *counts, "state")


def _fetch_log(events):
    return fetch_log(events, "user_id", F.col("event_type") == "signup")


def _ledger_columns(ledger):
    return ledger.select("url", "failures", "state", "closed_seq")


def retry_ledger(spark, sf_dir):
    return _ledger_columns(traversal.retry_ledger(_fetch_log(read_table(spark, f"{sf_dir}/events.parquet"))))


# --- segment layout -------------------------------------------------------------------------------------------------
def index_text_lines(spark, sf_dir):
    return text_lines(segment(spark, sf_dir)["postings"])


def dump_text(spark, sf_dir):
    """The lines of a written text dump."""
    path = write_index(segment(spark, sf_dir)["postings"], scratch_path(spark, "dump"), "txt", datetime.now(timezone.utc))
    return spark.read.text(path).select(F.col("value").alias("line"))


def dump_table(spark, sf_dir):
    """The blocks of a written table dump."""
    path = write_index(segment(spark, sf_dir)["postings"], scratch_path(spark, "dump"), "parquet", datetime.now(timezone.utc))
    return spark.read.parquet(path).select("token", "block", "n_docs", F.array_join("doc_ids", ",").alias("doc_ids"))


def index_table(spark, sf_dir):
    blocks = postings.posting_blocks(segment(spark, sf_dir)["postings"])
    return blocks.select("token", "block", "n_docs", F.array_join("doc_ids", ",").alias("doc_ids"))


def postings_fixed(spark, sf_dir):
    return layout.fixed_layout(segment(spark, sf_dir)["postings"])


def posting_gaps(spark, sf_dir):
    return layout.posting_gaps(segment(spark, sf_dir)["postings"])


def postings_compact(spark, sf_dir):
    return layout.compact_layout(segment(spark, sf_dir)["postings"])


def document_compact(spark, sf_dir):
    return layout.compact_layout(cut_lineage(document_index(spark, sf_dir)))


def token_dict(spark, sf_dir):
    return segment(spark, sf_dir)["token_dict"].select("token", "offset")


def token_dict_fixed(spark, sf_dir):
    return layout.fixed_dictionary(token_dict(spark, sf_dir))


def token_dict_rejects(spark, sf_dir):
    """Tokens over 12 bytes, a width that this data does exceed."""
    return layout.too_long_tokens(token_dict(spark, sf_dir), width=12)


def token_trie(spark, sf_dir):
    return prefixes.trie(token_dict(spark, sf_dir)).withColumn("depth", F.col("depth").cast("bigint"))


def token_automaton(spark, sf_dir):
    """The transitions of the smallest automaton of the dictionary; a state is the first trie node in it, slot:depth."""
    edges = prefixes.automaton(token_dict(spark, sf_dir))
    state, target = (F.concat_ws(":", f"{end}_slot", f"{end}_depth").alias(end) for end in ("state", "target"))
    return edges.select(state, "letter", target, "final")


def segment_roundtrip(spark, sf_dir):
    """Write a segment of its own with the fixed layout, and join what is read back. Too long tokens have no slot."""
    written = publish(_pages(spark, sf_dir), scratch_path(spark, "roundtrip"), "fixed", compact=False)
    slots = written["token_dict_fixed"].select("token", "slot")
    offsets = written["token_dict"].select("token", "offset").join(slots, "token", "left")
    return written["postings"].join(offsets, "token").join(written["doc_table"], "doc_id").select(
        "token", "offset", "slot", "url"
    )


def segment_meta(spark, sf_dir):
    return segment(spark, sf_dir)["segment_meta"].drop("created_at")


def _split(spark, sf_dir):
    """The index cut into segments by page, each with ids of its own: ``(doc tables, postings)``."""
    written = segment(spark, sf_dir)
    cut = documents.first_fetches(_pages(spark, sf_dir)).join(written["doc_table"], "url").select(
        (F.col("page_id") % N_SEGMENTS).alias("segment_id"), "url", F.col("doc_id").alias("old_id")
    )
    ranked = cut_lineage(ordering.dense_rank(cut, "segment_id", "url", out="rank"))
    # One row per segment.
    starts = ranked.groupBy("segment_id").agg(F.min("rank").alias("start"))
    numbered = ranked.join(F.broadcast(starts), "segment_id").withColumn("doc_id", F.col("rank") - F.col("start"))
    rows = written["postings"].withColumnRenamed("doc_id", "old_id").join(numbered, "old_id")
    return numbered.select("segment_id", "doc_id", "url"), rows.select("segment_id", "token", "doc_id")


def written_segments(spark, sf_dir):
    """The index as several written segments in one folder, opened together. They are written once per session."""
    key = (spark.sparkContext.applicationId, f"{sf_dir} in segments")
    if key not in _published:
        docs, rows = _split(spark, sf_dir)
        folder, now = scratch_path(spark, "segments"), datetime.now(timezone.utc)
        # The rows are renumbered once, and each segment reads its own.
        path = scratch_path(spark, "split")
        rows.write.partitionBy("segment_id").parquet(path)
        rows = spark.read.schema("token string, doc_id bigint, segment_id bigint").parquet(path)
        for segment_id in range(N_SEGMENTS):
            own = F.col("segment_id") == segment_id
            write_segment(rows.where(own), docs.where(own), folder, str(segment_id), True, now, BLOCK_ROWS)
        _published[key] = read_segments(spark, folder)
    return _published[key]


def segment_search(spark, sf_dir):
    written = written_segments(spark, sf_dir)
    found = segments.search_segments(_terms(spark, sf_dir), written)
    return found.select("term", F.col("segment_id").cast("bigint").alias("segment_id"), "url")


def segment_merge(spark, sf_dir):
    written = written_segments(spark, sf_dir)
    merged_docs, merged = segments.merge_segments(written["doc_table"], written["postings"])
    return merged.join(merged_docs, "doc_id").select("token", "doc_id", "url")


# --- read side ------------------------------------------------------------------------------------------------------
def token_lookup(spark, sf_dir):
    written = segment(spark, sf_dir)
    return search.look_up(_terms(spark, sf_dir), written["token_dict"], written["token_edges"]).select("token", "n_docs", "offset")


def search_urls(spark, sf_dir):
    written = segment(spark, sf_dir)
    return search.search(_terms(spark, sf_dir), written["postings"], written["posting_edges"], written["doc_table"])


def prefix_search(spark, sf_dir):
    return search.with_prefix(segment(spark, sf_dir)["token_dict"], "th").select("token", "n_docs", "offset")


def prefix_completion(spark, sf_dir):
    """The first letters of each benchmark term, three or all it has, completed from the dictionary."""
    heads = _terms(spark, sf_dir).select(F.substring("term", 1, 3).alias("prefix")).distinct()
    return search.complete(heads, segment(spark, sf_dir)["token_dict"])


def token_range(spark, sf_dir):
    return search.in_range(segment(spark, sf_dir)["token_dict"], "con", "est").select("token", "n_docs", "offset")


def sampled_index(spark, sf_dir):
    return search.sampled_index(segment(spark, sf_dir)["token_dict"], SAMPLE_EVERY)


def sampled_lookup(spark, sf_dir):
    """The sample before each term, from the sampled index as it was written."""
    return search.find_samples(_terms(spark, sf_dir), segment(spark, sf_dir)["token_samples"])


# --- streaming ------------------------------------------------------------------------------------------------------
def _in_batches(spark, table, batch, name):
    """The table as a folder that a stream reads in ``N_BATCHES`` batches, and the files of each.

    ``batch`` is the number of a row's batch. A stream takes files in the order in which they were written.
    """
    path, files = scratch_path(spark, name), table.rdd.getNumPartitions()
    for number in range(N_BATCHES):
        table.where(batch == number).repartition(files).write.mode("append").parquet(path)
    return path, files


def stream_index(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    source, files = _in_batches(spark, pages, F.col("page_id") % N_BATCHES, "page-files")
    out = scratch_path(spark, "stream-index")
    jobs.index_stream(jobs.page_stream(spark, source, files), out, scratch_path(spark, "stream-state")).awaitTermination()
    docs, rows = jobs.read_stream_index(spark, out)
    return rows.join(docs.select("doc_id", "url"), "doc_id").select("token", "doc_id", "url")


def stream_visited(spark, sf_dir):
    source = scratch_path(spark, "queue-files")
    _queue(spark, sf_dir).repartition(3).write.parquet(source)
    out = scratch_path(spark, "stream-visited")
    urls = spark.readStream.schema("url string").option("maxFilesPerTrigger", 1).parquet(source)
    jobs.first_sightings(urls).writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", scratch_path(spark, "stream-state")
    ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("url string").parquet(out)


def stream_retry(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    source, files = _in_batches(spark, events, F.col("event_id") % N_BATCHES, "event-files")
    arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(source)
    out = scratch_path(spark, "stream-retry")
    jobs.retry_stream(_fetch_log(arriving), out, scratch_path(spark, "stream-state")).awaitTermination()
    return _ledger_columns(jobs.read_retry_ledger(spark, out))


def all_queries() -> dict[str, Query]:
    listed = [
        seed_urls, fetch_frontier, page_links, resolved_links, unvisited_links, visited_dedup, page_text, page_tokens,
        stemmed_vocab, doc_terms, doc_table, inverted_index, document_index, doc_frequency, doc_lookup, doc_listing,
        doc_count, indexed_urls, crawl_reachable, crawl_outcome, crawl_retry, retry_ledger, index_text_lines, index_table,
        postings_fixed, posting_gaps, postings_compact, document_compact, token_dict, token_dict_fixed,
        token_dict_rejects, token_trie, token_automaton, segment_roundtrip, segment_meta, segment_search, segment_merge, token_lookup,
        search_urls, prefix_search, prefix_completion, token_range, sampled_index, sampled_lookup, stream_index,
        stream_visited, stream_retry, href_cases, doc_table_extend, crawl_index, dump_text, dump_table,
    ]
    return {query.__name__: query for query in listed}

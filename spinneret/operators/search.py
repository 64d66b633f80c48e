"""Read side: token look-up, search, prefix and range scans, sampled index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinneret.functions.markup import tokens_of
from spinneret.functions.stemming import with_stem
from spinneret.operators.blocks import BROADCAST_TERMS, find_blocks, rows_of
from spinneret.operators.ordering import POSITION, RANGE, in_ranges, ranked_tokens, scan_max
from spinneret.session import cut_lineage, has_at_most


def query_terms(texts: DataFrame, column: str = "text") -> DataFrame:
    """``(term)``: distinct stems of the words in query texts, prepared as page text is."""
    words = texts.select(F.explode(tokens_of(column)).alias("token")).distinct()
    return cut_lineage(with_stem(words, "token", out="term").select("term").distinct())


def _sized(terms: DataFrame) -> DataFrame:
    """Broadcast a checked number of terms; beyond it the join shuffles and splits hot tokens at run time."""
    return F.broadcast(terms) if has_at_most(terms, BROADCAST_TERMS) else terms


def _in_blocks(terms: DataFrame, table: DataFrame, edges: DataFrame) -> DataFrame:
    """The rows of a table in blocks whose token is one of ``(term)``; reads the blocks that may hold them only."""
    one = F.lit(0).cast("bigint").alias("segment")
    found = find_blocks(terms.select(one, "term"), edges.select(one, "block", "first", "last"))
    return rows_of(table, found.select("block", "token"), "block").drop("block")


def look_up(terms: DataFrame, token_dict: DataFrame, edges: DataFrame) -> DataFrame:
    """Dictionary entries of ``(term)``, from the dictionary in blocks and the blocks' ``(block, first, last)``."""
    return _in_blocks(terms, token_dict, edges)


def search(terms: DataFrame, postings: DataFrame, edges: DataFrame, doc_table: DataFrame) -> DataFrame:
    """``(term, url)``: the documents of each term, from the postings in blocks and the blocks' edges."""
    hits = _in_blocks(terms, postings, edges)
    found = hits.join(doc_table.select("doc_id", "url"), "doc_id")
    return found.select(F.col("token").alias("term"), "url")


def search_words(words: list[str], postings: DataFrame, edges: DataFrame, doc_table: DataFrame) -> DataFrame:
    """Search for a short list of words."""
    texts = postings.sparkSession.createDataFrame([(w,) for w in words], "text string")
    return search(query_terms(texts), postings, edges, doc_table)


def with_prefix(token_dict: DataFrame, prefix: str) -> DataFrame:
    """Dictionary entries that start with ``prefix``; the filter reaches the scan."""
    return token_dict.where(F.col("token").startswith(prefix))


def complete(prefixes: DataFrame, token_dict: DataFrame) -> DataFrame:
    """``(prefix, token, offset)`` for many prefixes: an equality join on the prefixes of each token.

    Only lengths that are asked for are spelled out. A prefix's result is as long as its number of tokens.
    """
    lengths = [row.n for row in prefixes.select(F.length("prefix").alias("n")).distinct().where("n > 0").collect()]
    if not lengths:
        return token_dict.select(F.lit("").alias("prefix"), "token", "offset").where("false")
    heads = F.array(*[F.when(F.length("token") >= n, F.substring("token", 1, n)) for n in sorted(lengths)])
    spelled = token_dict.select(F.explode(heads).alias("prefix"), "token", "offset")
    return spelled.join(_sized(prefixes.select("prefix").distinct()), "prefix")


def in_range(token_dict: DataFrame, low: str, high: str) -> DataFrame:
    """Dictionary entries between two tokens, both included; range-sorted files outside are skipped."""
    return token_dict.where(F.col("token").between(low, high))


def sampled_index(token_dict: DataFrame, every: int, ranked: DataFrame | None = None) -> DataFrame:
    """``(block, token, offset, n_tokens)``: each ``every``-th dictionary entry, first of its block.

    ``ranked`` are the :func:`spinneret.operators.ordering.ranked_tokens` of the dictionary, if they are at hand.
    """
    ranked = ranked_tokens(token_dict) if ranked is None else ranked
    blocks = ranked.groupBy(F.floor(F.col("slot") / every).cast("bigint").alias("block"))
    first = F.min(F.struct("token", "offset"))
    return blocks.agg(first.alias("first"), F.count(F.lit(1)).alias("n_tokens")).select(
        "block", "first.token", "first.offset", "n_tokens"
    )


def find_samples(terms: DataFrame, samples: DataFrame) -> DataFrame:
    """``(term, block)``: the block that would hold each term, NULL before the first one.

    Block numbers rise with the tokens, so this is a running maximum over terms and samples in one order.
    """
    starts = samples.select(F.col("token").alias("key"), F.lit(0).alias("is_term"), "block")
    asked = terms.select(F.col("term").alias("key"), F.lit(1).alias("is_term"), F.lit(None).cast("bigint").alias("block"))
    placed = scan_max(in_ranges(starts.unionByName(asked), "key", "is_term"), "block", out="found")
    return placed.where("is_term = 1").select(F.col("key").alias("term"), F.col("found").alias("block")).drop(RANGE, POSITION)

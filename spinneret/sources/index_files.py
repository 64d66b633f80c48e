"""Writers and readers of the index: text and table dumps, segments."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spinneret.operators import layout as layouts
from spinneret.operators.blocks import BLOCK_ROWS, block_edges, number_of_blocks, write_blocks
from spinneret.operators.ordering import ranked_tokens
from spinneret.operators.postings import posting_blocks
from spinneret.operators.prefixes import trie_nodes
from spinneret.operators.search import sampled_index
from spinneret.operators.segments import segment_meta
from spinneret.session import cut_lineage

# Every how many dictionary entries the sampled index has one.
SAMPLE_EVERY = 64
TRIE = ["slot", "depth", "val", "is_terminal", "offset", "n_children"]
SCHEMAS = {
    "postings": "token string, doc_id bigint, block bigint",
    "posting_edges": "block bigint, first string, last string",
    "token_dict": "token string, n_docs bigint, n_bytes bigint, offset bigint, block bigint",
    "token_edges": "block bigint, first string, last string",
    "token_samples": "block bigint, token string, offset bigint, n_tokens bigint",
    "token_dict_fixed": "slot bigint, token string, offset bigint, record_at bigint",
    "token_dict_rejects": "token string, token_bytes bigint",
    "token_dict_trie": "slot bigint, depth int, val string, is_terminal boolean, offset bigint, n_children bigint",
    "doc_table": "doc_id bigint, url string",
}
META = "token_count bigint, doc_count bigint, first_token string, last_token string, created_at string"
# The tables in blocks, and where the edges of their blocks are.
EDGES = {"postings": "posting_edges", "token_dict": "token_edges"}


# --- Fixed values: the lines of a text dump -------------------------------------------------------------------------
TOKEN_LINE = ("Token: Token[key=", "]")
DOCUMENT_LINE = ("------DocId: ", "-----")
# --------------------------------------------------------------------------------------------------------------------


def text_lines(postings: DataFrame) -> DataFrame:
    """``(token, doc_id, line)``: a header line per token (``doc_id`` -1) and a line per document."""
    heads = postings.select("token").distinct().select(
        "token",
        F.lit(-1).cast("bigint").alias("doc_id"),
        F.concat(F.lit(TOKEN_LINE[0]), F.col("token"), F.lit(TOKEN_LINE[1])).alias("line"),
    )
    line = F.concat(F.lit(DOCUMENT_LINE[0]), F.col("doc_id").cast("string"), F.lit(DOCUMENT_LINE[1]))
    docs = postings.select("token", "doc_id", line.alias("line"))
    return heads.unionByName(docs)


def output_name(base: str, at: datetime) -> str:
    return f"{base}_{at:%Y%m%d_%H%M%S}"


def write_index(postings: DataFrame, base: str, fmt: str, at: datetime) -> str:
    """Dump the index as ``txt`` lines or a ``parquet`` table, in token order; returns the path.

    Files are cut by (token, id) ranges, so a hot token spreads over several of them.
    """
    if fmt == "txt":
        path = output_name(base, at) + ".txt"
        lines = text_lines(postings).repartitionByRange("token", "doc_id").sortWithinPartitions("token", "doc_id")
        lines.select("line").write.text(path)
    elif fmt == "parquet":
        path = output_name(base, at) + ".parquet"
        blocks = posting_blocks(postings).repartitionByRange("token", "block").sortWithinPartitions("token", "block")
        blocks.write.parquet(path)
    else:
        raise ValueError(f"unknown index format: {fmt}")
    return path


def _write_sorted(df: DataFrame, path: str, *keys: str) -> None:
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.parquet(path)


def write_segment(
    postings: DataFrame, doc_table: DataFrame, folder: str, segment_id: str, compact: bool, created_at: datetime, block_rows: int = BLOCK_ROWS
) -> str:
    """Write one segment: postings and dictionary in blocks, the other dictionaries, document table, metadata.

    Each table of ``folder`` has a partition for each segment, whose id must be new; returns the folder. Tokens too long for the fixed-width dictionary are a table of their own. The trie is written
    as nodes, which do not spell their prefixes. ``token`` gets a Parquet Bloom filter, so that a look-up skips the row
    groups of a block that cannot hold it.
    """
    base = folder.rstrip("/")

    def at(name: str) -> str:
        return f"{base}/{name}/segment_id={segment_id}"

    token_dict = cut_lineage(layouts.layout(postings, compact))
    n_tokens, n_rows = token_dict.agg(F.count(F.lit(1)), F.sum("n_docs")).first()
    for name, table, keys, n in (("postings", postings.select("token", "doc_id"), ("token", "doc_id"), n_rows or 0), ("token_dict", token_dict, ("token",), n_tokens)):
        n_blocks = number_of_blocks(n, block_rows)
        bloom = {"parquet.bloom.filter.enabled#token": "true", "parquet.bloom.filter.expected.ndv#token": str(2 * n_tokens // n_blocks + 1)}
        write_blocks(table, at(name), *keys, n_blocks=n_blocks, **bloom)
    spark = postings.sparkSession
    for name, edges in EDGES.items():
        block_edges(spark.read.schema(SCHEMAS[name]).parquet(at(name))).coalesce(1).write.parquet(at(edges))
    ranked = ranked_tokens(token_dict)
    _write_sorted(sampled_index(token_dict, SAMPLE_EVERY, ranked), at("token_samples"), "block")
    _write_sorted(layouts.fixed_dictionary(token_dict), at("token_dict_fixed"), "slot")
    _write_sorted(layouts.too_long_tokens(token_dict), at("token_dict_rejects"), "token")
    _write_sorted(trie_nodes(token_dict, ranked)[0].select(*TRIE), at("token_dict_trie"), "slot", "depth")
    _write_sorted(doc_table.select("doc_id", "url"), at("doc_table"), "doc_id")
    meta = segment_meta(token_dict, doc_table, segment_id)
    stamped = meta.withColumn("created_at", F.lit(f"{created_at:%Y-%m-%dT%H:%M:%SZ}"))
    stamped.drop("segment_id").write.json(at("segment_meta"))
    return base


def read_segments(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of all segments in a folder by name, each with the column ``segment_id`` as the folders spell it."""
    tables = {name: spark.read.schema(f"{schema}, segment_id string").parquet(f"{folder}/{name}") for name, schema in SCHEMAS.items()}
    tables["segment_meta"] = spark.read.schema(f"{META}, segment_id string").json(f"{folder}/segment_meta")
    return tables


def read_segment(spark: SparkSession, folder: str, segment_id: str) -> dict[str, DataFrame]:
    """The tables of one segment by name."""
    at = f"segment_id={segment_id}"
    tables = {name: spark.read.schema(schema).parquet(f"{folder}/{name}/{at}") for name, schema in SCHEMAS.items()}
    meta = spark.read.schema(META).json(f"{folder}/segment_meta/{at}")
    tables["segment_meta"] = meta.select(F.lit(segment_id).alias("segment_id"), *meta.columns)
    return tables

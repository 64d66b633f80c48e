"""Operator 13: importance resampling towards a target distribution, with Arrow kernels.

Features of a text are its words and pairs of neighbouring words, hashed into buckets. A batch of texts is lower-cased,
split and flattened by Arrow kernels, its words are dictionary-encoded, and pairs are pairs of shifted dictionary
indices, dictionary-encoded in turn: each distinct word and pair of a batch is hashed once, and the hashes are taken
back to their places. A bucket's gain is the scaled log ratio of its smoothed shares in the target texts and in all
documents; a document's weight is its features' mean gain, a segment reduction over the batch. With Gumbel noise drawn
from the doc_id, the highest scores are a sample without replacement in proportion to the weights' exponentials.

Both passes go over the rows without shuffling texts: the first returns one count per bucket and task, the second one
small row per document. Bucket tables have a row for each of ``buckets``, whatever the input, so they are collected. The
rank is read off range partitions, in which equal rows are spread by their row number, so no key is hot.

A null text is empty: no features, weight 0. A null doc_id draws as an empty one and comes last in ties. Rows of one
doc_id are ranked each on its own. Without documents, or without target texts, the counts are zero; the smoothing keeps
the gains defined.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinneret.llm.common import digest_group, id_digest
from spinneret.operators.ordering import dense_rank
from spinneret.session import cut_lineage

#: What stands between words once A-Z are lower-cased.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS, PERCENT, MIN_WORDS, SEED = 10_000, 25, 20, 7
#: Bytes of text that are split at a time; one longer text is a part of its own.
PART_BYTES = 4 << 20


def parts(texts: pa.Array) -> Iterator[pa.Array]:
    """The batch in slices of about ``PART_BYTES``."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(sizes) // PART_BYTES
    edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1), len(texts)]
    for start, end in zip(edges, edges[1:]):
        yield texts.slice(start, end - start)


def _crc(words: list[bytes], before: list[int]) -> np.ndarray:
    return np.fromiter((zlib.crc32(w, b) for w, b in zip(words, before)), np.int64, len(words))


def features(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row and bucket of each word, then row and bucket of each pair of neighbours, in the order of the texts."""
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), GAP)
    words, rows = pc.list_flatten(lists), pc.list_parent_indices(lists)
    worded = pc.not_equal(words, "")
    encoded = pc.filter(words, worded).dictionary_encode()
    rows = pc.filter(rows, worded).to_numpy()
    codes = encoded.indices.to_numpy()
    spelled = encoded.dictionary.cast(pa.binary()).to_pylist()
    sums = _crc(spelled, [0] * len(spelled))
    near = rows[1:] == rows[:-1]
    shifted = (codes[:-1][near].astype(np.int64) << 32) | codes[1:][near]
    pairs = pa.array(shifted, pa.int64()).dictionary_encode()
    distinct = pairs.dictionary.to_numpy()
    spaced = [b" " + w for w in spelled]
    after = _crc([spaced[k] for k in (distinct & 0xFFFFFFFF).tolist()], sums[distinct >> 32].tolist())
    return rows, (sums % buckets)[codes], rows[1:][near], (after % buckets)[pairs.indices.to_numpy()]


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n)``: how many features of all ``texts(text)`` fall into each bucket that has any."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in parts(batch.column("text")):
                _, single, _, double = features(part, buckets)
                total += np.bincount(single, minlength=buckets) + np.bincount(double, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["bucket", "n"])

    return texts.select("text").mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket: 1000 times the log of its smoothed share in ``target`` over that in ``docs``, floored.

    Only the two count tables, of at most ``buckets`` rows, come to the driver.
    """

    def counted(texts: DataFrame) -> list[int]:
        found = dict(bucket_counts(texts, buckets).collect())
        return [found.get(b, 0) for b in range(buckets)]

    s, t = counted(docs), counted(target)
    total_s, total_t = float(sum(s) + buckets), float(sum(t) + buckets)
    gains = (math.floor(1000 * math.log((t[b] + 1.0) * total_s / ((s[b] + 1.0) * total_t))) for b in range(buckets))
    return np.fromiter(gains, np.int64, buckets)


def with_weight(docs: DataFrame, gains: np.ndarray, out: str = "importance") -> DataFrame:
    """All rows with a struct ``out`` of ``n_words, n_features, weight``; a column of that name is replaced."""
    names = ("n_words", "n_features", "weight")

    @F.arrow_udf("struct<n_words: bigint, n_features: bigint, weight: bigint>")
    def weigh(texts: pa.Array) -> pa.Array:
        made = []
        for part in parts(texts):
            rows, single, near, double = features(part, len(gains))
            n_words, n_pairs = np.bincount(rows, minlength=len(part)), np.bincount(near, minlength=len(part))
            summed = _segment_sums(gains[single], n_words) + _segment_sums(gains[double], n_pairs)
            n = n_words + n_pairs
            made.append((n_words, n, summed // np.maximum(n, 1)))
        columns = [np.concatenate(c) for c in zip(*made)] or [np.empty(0)] * 3
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return docs.withColumn(out, weigh("text"))


def _segment_sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive segments, some of which may be empty."""
    running = np.concatenate([np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)])
    ends = np.cumsum(lengths)
    return running[ends] - running[ends - lengths]


def _score(seed: int):
    """Weight plus Gumbel noise from the document's id, both in thousandths."""
    share = (digest_group(id_digest(seed), 0) + F.lit(0.5)) / F.lit(4294967296.0)
    return F.col("weight") + F.floor(F.lit(-1000.0) * F.log(-F.log(share))).cast("bigint")


def ranked(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED, buckets: int = BUCKETS
) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)``, one row per row of ``docs``.

    Of the N rows with at least ``min_words`` words, floor(percent * N / 100) of the highest scores are drawn, ties to
    the smaller doc_id; ``rank`` numbers them from 1 and is null for all others.
    """
    weighed = with_weight(docs.select("doc_id", "text"), bucket_gains(docs, target, buckets))
    flat = weighed.select("doc_id", "importance.*")
    scored = cut_lineage(flat.withColumn("score", _score(seed)))
    asked = scored.where(F.col("n_words") >= min_words)
    k = percent * asked.count() // 100
    # The row number orders rows that are equal in all else, and spreads them over the ranges.
    keys = asked.select(
        "doc_id", "n_features", "weight", "score", (-F.col("score")).alias("_down"), F.col("doc_id").isNull().alias("_nameless"),
        F.monotonically_increasing_id().alias("_row"),
    )
    placed = dense_rank(keys, "_down", "_nameless", "doc_id", "n_features", "weight", "_row", out="_place")
    rank = F.when(F.col("_place") < k, F.col("_place") + 1).cast("bigint").alias("rank")
    columns = ["doc_id", "n_features", "weight", "score"]
    rest = scored.where(F.col("n_words") < min_words).select(*columns, F.lit(None).cast("bigint").alias("rank"))
    return placed.select(*columns, rank).unionByName(rest)


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED, buckets: int = BUCKETS
) -> DataFrame:
    """The drawn rows with all their columns, in no order.

    The last drawn (score, doc_id) is the cut; rows of one doc_id that are equal to it in score are all drawn.
    """
    gains = bucket_gains(docs, target, buckets)
    packed = docs.select("doc_id", "text", F.struct(*[docs[c] for c in docs.columns]).alias("doc"))
    scored = with_weight(packed, gains).select("doc_id", "doc", "importance.*").withColumn("score", _score(seed))
    scored = scored.where(F.col("n_words") >= min_words)
    slim = cut_lineage(scored.select("doc_id", (-F.col("score")).alias("_down"), F.col("doc_id").isNull().alias("_nameless"), F.monotonically_increasing_id().alias("_row")))
    k = percent * slim.count() // 100
    last = dense_rank(slim, "_down", "_nameless", "doc_id", "_row", out="_place").where(F.col("_place") == k - 1).first()
    if last is None:
        return docs.where("false")
    key = F.struct((-F.col("score")).alias("a"), F.col("doc_id").isNull().alias("b"), F.coalesce("doc_id", F.lit(0)).alias("c"))
    cut = F.struct(F.lit(last["_down"]).alias("a"), F.lit(last["_nameless"]).alias("b"), F.lit(last["doc_id"] or 0).cast("bigint").alias("c"))
    return scored.where(key <= cut).select("doc.*")


def importance_digest(docs: DataFrame, target: DataFrame) -> DataFrame:
    """The rows of :func:`ranked` with the parameters of the checked query."""
    return ranked(docs, target)

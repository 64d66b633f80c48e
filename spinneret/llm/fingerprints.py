"""Operator 10: document fingerprints by order min-hash.

The k-mers of a text, runs of ``K`` code points, are numbered by occurrence, so a repeated k-mer counts as often as it
occurs. Under each of ``SKETCHES`` hash functions the ``KEPT`` least of the numbered k-mers are selected, put back into
the order they have in the text, and hashed as a tuple. Two texts agree in one of the values if the same k-mers are
least in both and stand in the same order, which is likely when few edits lead from one text to the other.

The query also needs each document's successor by descending doc_id. Ids are cut into ranges at quantiles; the first
document of a range is sent to the range above as well, so that every range is a task of its own that sees each of its
documents together with the next one. That is one exchange of the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinneret.llm.shingles import minhash_parameters, mix

K = 8
SKETCHES = 64
KEPT = 2
#: k-mers that are hashed under all functions at once.
_BLOCK = 1 << 12
_ROWS = np.arange(SKETCHES)
_PARAMETERS = tuple(p[:, None] for p in minhash_parameters(SKETCHES, seed=10))
_SHIFT, _SPREAD = np.uint32(15), np.uint32(0x85EBCA6B)


def _numbered(points: np.ndarray) -> np.ndarray:
    """A 32-bit hash for each k-mer and its occurrence number, in text order; a short text is one k-mer."""
    k, base = min(K, len(points)), 0x9E3779B97F4A7C15
    # Runs are doubled as long as they fit, then grow by single code points.
    ones = points.astype(np.uint64) + np.uint64(1)
    kmers, size = ones, 1
    while 2 * size <= k:
        kmers = kmers[:-size] * np.uint64(pow(base, size, 1 << 64)) + kmers[size:]
        size *= 2
    for i in range(size, k):
        kmers = kmers[:-1] * np.uint64(base) + ones[i:]
    kmers = mix(kmers)
    order = np.argsort(kmers)
    ordered = kmers[order]
    same = ordered[1:] == ordered[:-1]
    if same.any():
        # Only k-mers that occur again are put in the order of their places.
        runs = np.append(0, np.cumsum(~same))
        repeated = np.append(same, False) | np.append(False, same)
        runs, places = np.divmod(np.sort(runs[repeated] * len(kmers) + order[repeated]), len(kmers))
        starts = np.flatnonzero(np.append(True, runs[1:] != runs[:-1]))
        turn = np.arange(len(runs)) - np.repeat(starts, np.diff(np.append(starts, len(runs))))
        places, turn = places[turn > 0], turn[turn > 0]
        kmers[places] = mix(kmers[places] + turn.astype(np.uint64))
    return (kmers >> np.uint64(32)).astype(np.uint32)


def _kmers_of(text: str) -> np.ndarray:
    return _numbered(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32))


def _least(numbered: np.ndarray, start: int, end: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The ``KEPT`` least hashes of each block of the k-mers ``start`` to ``end`` under each function, and their places."""
    factors, masks = _PARAMETERS
    buffers = np.empty((2, SKETCHES, min(_BLOCK, max(0, end - start))), np.uint32)
    found = []
    for at in range(start, end, _BLOCK):
        part = numbered[at : min(at + _BLOCK, end)]
        hashed, shifted = buffers[:, :, : len(part)]
        np.bitwise_xor(part, masks, out=hashed)
        np.multiply(hashed, factors, out=hashed)
        np.right_shift(hashed, _SHIFT, out=shifted)
        np.bitwise_xor(hashed, shifted, out=hashed)
        np.multiply(hashed, _SPREAD, out=hashed)
        for _ in range(min(KEPT, len(part))):
            least = hashed.argmin(axis=1)
            found.append((hashed[_ROWS, least], least + at))
            hashed[_ROWS, least] = 0xFFFFFFFF
    return found


def _in_order(numbered: np.ndarray, found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The values of a fingerprint: the least k-mers of each function, in the order of the text, hashed as a tuple.

    Of equal hashes the one found first counts; a text of fewer k-mers has zeros for the others.
    """
    where = np.stack([places for _, places in found], axis=1)
    if len(found) > KEPT:
        pick = np.argsort(np.stack([values for values, _ in found], axis=1), axis=1, kind="stable")[:, :KEPT]
        where = where[_ROWS[:, None], pick]
    where.sort(axis=1)
    out = np.zeros(SKETCHES, np.uint64)
    for _ in range(KEPT - where.shape[1]):
        out = mix(out)
    for i in range(where.shape[1]):
        out = mix(out + (numbered[where[:, i]].astype(np.uint64) + np.uint64(1)))
    return (out >> np.uint64(32)).astype(np.uint32)


def fingerprint(text: str | None) -> np.ndarray:
    """``SKETCHES`` 32-bit values; an empty text, and a null one, has all zeros."""
    return _with_beginning(text or "", 0)[0]


def _with_beginning(text: str, n_points: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The fingerprint, and what is least in the first ``n_points`` code points, which texts of that beginning share.

    An occurrence number counts from the start of the text, so k-mers inside the beginning are the same in all of them.
    """
    if not text:
        return np.zeros(SKETCHES, np.uint32), []
    numbered = _kmers_of(text)
    shared = max(0, n_points - K + 1)
    begun = _least(numbered, 0, shared)
    return _in_order(numbered, begun + _least(numbered, shared, len(numbered))), begun


def _continued(text: str, n_points: int, begun: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The fingerprint of a text whose first ``n_points`` code points :func:`_with_beginning` has read in another one."""
    if not begun:
        return fingerprint(text)
    numbered = _kmers_of(text)
    return _in_order(numbered, begun + _least(numbered, n_points - K + 1, len(numbered)))


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """The share of equal values, 0 to 1."""
    return float((one == other).mean())


def as_text(values: np.ndarray) -> str:
    """Eight hexadecimal digits a value."""
    return values.astype(">u4").tobytes().hex()


def with_fingerprint(docs: DataFrame, out: str = "fingerprint") -> DataFrame:
    """All columns with the text's fingerprint as hexadecimal digits. No shuffle."""

    @F.pandas_udf("string")
    def made(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: as_text(fingerprint(t)))

    return docs.withColumn(out, made("text"))


def edited(text: str, following: str) -> str:
    """The last floor(n/2) code points give way to the first as many of the following text, or all it has."""
    return text[: _unedited(text)] + following[: len(text) // 2]


def _unedited(text: str) -> int:
    """The code points that an edited text begins with."""
    return len(text) - len(text) // 2


def _ranges(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_range``; larger ids are in smaller ranges, rows without an id in the last one.

    The quantiles are taken over all ids. A range takes the rows of whole ids, so a repeated id's rows share one.
    """
    n = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 100 * n) if n > 1 else F.lit(None)).first()[0]
    cuts = sorted(set(cuts or []), reverse=True)
    above = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>"), lambda c: c >= F.col("doc_id")))
    return docs.withColumn("_range", F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(above))


def edit_digest(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, its edited text's, and their likeness to each other and to the next one's.

    The next document is the one with the next smaller doc_id; after the last comes the first. Rows without an id come
    last; rows of one id are ordered by their text. A null text is an empty one. Extra columns play no part.
    """
    rows = _ranges(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    # The first row of each range also ends the range before it; the very first one ends the last range.
    order = F.struct(F.col("doc_id").isNotNull(), "doc_id", "digest")
    firsts = rows.withColumn("digest", F.sha2("text", 256)).groupBy("_range").agg(F.max(order).alias("first"))
    found = [(r["_range"], r["first"]["doc_id"], r["first"]["digest"]) for r in firsts.orderBy("_range").collect()]
    ends = [(r, d, h, found[i - 1][0]) for i, (r, d, h) in enumerate(found)]
    table = docs.sparkSession.createDataFrame(ends, "_range int, _id bigint, _digest string, _before int")
    firsts = rows.join(F.broadcast(table), "_range").where(F.col("doc_id").eqNullSafe(F.col("_id")) & (F.sha2("text", 256) == F.col("_digest")))
    firsts = firsts.select("doc_id", "text", F.col("_before").alias("_range")).dropDuplicates(["_range"])
    both = rows.withColumn("_end", F.lit(0)).unionByName(firsts.withColumn("_end", F.lit(1)))
    both = both.withColumn("_digest", F.when(F.col("_end") == 0, F.sha2("text", 256)))
    both = both.repartition("_range").sortWithinPartitions("_range", "_end", F.desc_nulls_last("doc_id"), F.desc("_digest"))

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            out = []
            for doc_id, text, end in zip(batch["doc_id"], batch["text"], batch["_end"]):
                own, begun = (None, None) if end else _with_beginning(text, _unedited(text))
                if held is not None:
                    before, before_text, before_own, before_begun = held
                    following = fingerprint(text) if own is None else own
                    changed = edited(before_text, text)
                    changed_print = _continued(changed, _unedited(before_text), before_begun)
                    out.append((
                        before, len(before_text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), as_text(before_own),
                        as_text(changed_print), likeness(before_own, changed_print), likeness(before_own, following),
                    ))
                held = None if end else (doc_id, text, own, begun)
            yield pd.DataFrame(out, columns=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    schema = "doc_id string, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    made = both.select(F.col("doc_id").cast("string").alias("doc_id"), "text", "_end").mapInPandas(digest, schema)
    return made.withColumn("doc_id", F.col("doc_id").cast("bigint"))

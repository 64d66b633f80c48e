"""Operator 8: benchmark decontamination by pigeonhole edit matching.

An item of n characters may be found with up to k = floor(RATE * n) edits. It is cut into k + 1 pieces; k edits leave
at least one piece untouched, so every occurrence holds an exact piece hit. One automaton finds the hits of all pieces
in one pass over a text; around each hit the item is aligned with Myers' bit-parallel algorithm, which keeps a whole
column of the edit matrix in one integer.

Items are a query set: they are taken in blocks of at most ``BLOCK_CHARS`` characters, each block is broadcast, and
every document meets every block. Nothing is shuffled but the matches found.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinneret.session import cut_lineage

RATE = 0.08
#: Characters of the items that are broadcast together.
BLOCK_CHARS = 4_000_000


def normal(text: str | None) -> str:
    """Lower case, runs of white space as one space, trimmed; this is what edits are counted on."""
    return " ".join((text or "").lower().split())


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget`` + 1 pieces (start, text) whose lengths differ by at most one."""
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


class Aligner:
    """Edit distance of one item to the best-matching substring of a text."""

    def __init__(self, item: str) -> None:
        self.length, self.top = len(item), 1 << (len(item) - 1)
        self.masks: dict[str, int] = {}
        for place, letter in enumerate(item):
            self.masks[letter] = self.masks.get(letter, 0) | 1 << place

    def distance(self, window: str, enough: int) -> int:
        """The least distance, or the first that is at most ``enough``."""
        full = (self.top << 1) - 1
        up, down, now = full, 0, self.length
        best = now
        for letter in window:
            equal = self.masks.get(letter, 0)
            across = (((equal & up) + up) ^ up) | equal | down
            plus, minus = down | (full & ~(across | up)), up & across
            if plus & self.top:
                now += 1
            elif minus & self.top:
                now -= 1
                if now < best:
                    best = now
                    if best <= enough:
                        return best
            # The text before the match costs nothing, so no horizontal carry comes in at the top.
            plus, minus = plus << 1 & full, minus << 1 & full
            seen = equal | down
            up, down = minus | (full & ~(seen | plus)), plus & seen
        return best


class Matcher:
    """All items of a block: finds which of them occur in a text within their budgets."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        self.items = {i: t for i, t in items if t}
        self.budgets = {i: int(RATE * len(t)) for i, t in self.items.items()}
        self.aligners: dict[int, Aligner] = {}
        owners: dict[str, list[tuple[int, int]]] = {}
        for i, t in self.items.items():
            for start, piece in pieces(t, self.budgets[i]):
                owners.setdefault(piece, []).append((i, start))
        self.automaton = ahocorasick.Automaton()
        for piece, at in owners.items():
            self.automaton.add_word(piece, (len(piece), at))
        self.automaton.make_automaton()

    def found_in(self, text: str) -> list[tuple[int, int]]:
        """``(item, distance)``, where the distance is the first found within the budget."""
        done: dict[int, int] = {}
        if not self.items:
            return []
        tried: set[tuple[int, int]] = set()
        for end, (length, owners) in self.automaton.iter(text):
            for item, start in owners:
                if item in done:
                    continue
                # Hits of one alignment lie on nearly one diagonal; a window is aligned once.
                origin, k = end + 1 - length - start, self.budgets[item]
                if (item, origin) in tried:
                    continue
                tried.add((item, origin))
                window = text[max(0, origin - k) : origin + len(self.items[item]) + k]
                if len(window) + k < len(self.items[item]):
                    continue
                aligner = self.aligners.setdefault(item, Aligner(self.items[item]))
                best = aligner.distance(window, k)
                if best <= k:
                    done[item] = best
        return list(done.items())


def item_blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The normalised items in blocks of bounded size, one after the other; items of one text appear once, as the
    least item_id. Empty items are left out."""
    clean = F.trim(F.regexp_replace(F.lower("text"), r"\s+", " "))
    distinct = items.select("item_id", clean.alias("text")).where("text <> '' and item_id is not null").groupBy("text").agg(F.min("item_id").alias("item_id"))
    chars = distinct.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-int(chars) // BLOCK_CHARS) if chars else 0
    blocks = max(1, 2 * n - 1) if n else 0
    cut = cut_lineage(distinct.withColumn("block", F.expr(f"pmod(xxhash64(text), {max(1, blocks)})")))
    for block in range(blocks):
        rows = cut.where(F.col("block") == block).select("item_id", "text").collect()
        yield sorted((r["item_id"], normal(r["text"])) for r in rows)


def matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``(doc_id, item_id, distance)``: the items that occur in each document within their edit budgets.

    One row per pair of distinct item text and document row; ``distance`` is at most the budget. Null texts match
    nothing; texts are matched whole, whatever their length.
    """
    found = None
    for block in item_blocks(items):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def scan(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            matcher = Matcher(shared.value)
            for batch in batches:
                rows = [(d, i, k) for d, t in zip(batch["doc_id"], batch["text"]) for i, k in matcher.found_in(normal(t))]
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "distance"])

        told = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
        part = told.mapInPandas(scan, "doc_id string, item_id bigint, distance bigint")
        part = part.withColumn("doc_id", F.col("doc_id").cast("bigint"))
        found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], "doc_id bigint, item_id bigint, distance bigint")
    return found


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_items, item_ids, contaminated``; the ids of the items found, ascending.

    All rows of a repeated doc_id get the union of what their texts hold. Extra columns play no part.
    """
    found = matches(docs, items).groupBy("doc_id").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    hit = found.withColumnRenamed("doc_id", "_id")
    joined = docs.select("doc_id").join(hit, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    ids = F.coalesce("item_ids", F.array().cast("array<bigint>"))
    return joined.select("doc_id", F.size(ids).cast("bigint").alias("n_items"), F.array_join(ids, ",").alias("item_ids"), (F.size(ids) > 0).alias("contaminated"))


def _is_clean(docs: DataFrame, block: list[tuple[int, str]]) -> F.Column:
    shared = docs.sparkSession.sparkContext.broadcast(block)

    @F.pandas_udf("boolean")
    def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(shared.value)
        for batch in texts:
            yield pd.Series([not matcher.found_in(normal(t)) for t in batch], dtype=bool)

    return clean(F.coalesce(docs["text"], F.lit("")))


def without_benchmark(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no item, with their own columns."""
    for block in item_blocks(items):
        docs = docs.where(_is_clean(docs, block))
    return docs

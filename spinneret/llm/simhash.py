"""Operator 12: near-duplicates by SimHash fingerprints, with pigeonring filtering.

A fingerprint's 64 bits are cut into ``SEGMENTS`` segments, laid out as a ring. If two fingerprints differ in at most d
bits, there is a segment from which every chain of l consecutive segments has at most l * d / SEGMENTS differences. For
3 bits and 8 segments the chains of 1 to 8 segments may differ in 0, 0, 1, 1, 1, 2, 2, 3 bits.

The head of the chain is a join key: the segments without a difference, and all but one of the segments up to the last
chain of at most one difference. That is 24 keys of 32 equal bits for each distinct fingerprint. Fingerprints with a key
in common are compared from that segment on: a pair goes as soon as a chain is over its budget, the last chain being the
full Hamming distance.

A key that more than ``CROWD`` fingerprints share is refined, since its pairs would be too many: the bits that it does
not fix hold all of a pair's differences, so of d + 1 parts of these bits one is equal, and each part is added to the
key in turn. A key that leaves b bits open has at most 2^b fingerprints, so this ends, every pair within d bits meets,
and no group is compared as a whole. Of the pairs found in a batch only a spanning forest goes on.

Equal fingerprints are one node, and a node's documents never meet. A null text is empty; a text without words has the
fingerprint zero, linked like any other. A row without a doc_id links others but is never the smallest; its component
is null if no row with an id is in it. Repeated rows get equal results, an empty table an empty one. Other columns of
the documents play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from spinneret.llm.common import components
from spinneret.session import cut_lineage

BITS, SEGMENTS = 64, 8
WIDTH = BITS // SEGMENTS
SEED = 42
#: More bits would need ever more keys in crowded places.
MOST_DISTANCE = 3
#: Most fingerprints of one key that are compared pair by pair.
CROWD = 256
#: Fingerprints with over one in this many of all rows are looked up by broadcast; there are fewer than this many.
HOT_SHARE = 1_000
#: Hashes whose bits are counted at a time, and key rows that are compared at a time.
_BLOCK, _ROWS = 1 << 15, 1 << 18
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: str | None, width: int) -> int:
    """Bit k is set if it is set in over half of the hashes of all ``width``-word shingles, repeats included.

    The six white-space bytes at which ``bytes.split`` cuts are just U+0020 and U+0009 to U+000D.
    """
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    width = min(width, len(words))
    n = len(words) - width + 1
    counts = np.zeros(BITS, np.int64)
    for start in range(0, n, _BLOCK):
        part = words[start : start + _BLOCK + width - 1]
        shingles = map(b" ".join, zip(*[part[k:] for k in range(width)]))
        hashes = np.fromiter((xxh64_intdigest(s, SEED) for s in shingles), np.uint64)
        counts += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << k for k in np.flatnonzero(2 * counts > n).tolist())


def sketch(docs: DataFrame, width: int) -> DataFrame:
    """``(doc_id, fp)`` with the fingerprint as a signed 64-bit number."""

    @F.pandas_udf("bigint")
    def mark(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, width) for t in texts], dtype=np.uint64).astype(np.int64)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), mark("text").alias("fp"))


def chain_budgets(distance: int) -> list[int]:
    """Most differences in the first 1, 2, ... segments of a chain."""
    return [length * distance // SEGMENTS for length in range(1, SEGMENTS + 1)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _segment_mask(segment: int) -> int:
    """Segment 0 has the highest bits; the ring closes after the last."""
    return ((1 << WIDTH) - 1) << (BITS - WIDTH * (segment % SEGMENTS + 1))


def head_masks(distance: int) -> list[tuple[int, int]]:
    """``(start, mask)`` of each key: a chain's segments without a difference, and all but one of those with at most one."""
    budgets = chain_budgets(distance)
    equal, loose = budgets.count(0), budgets.count(1)
    masks = []
    for start in range(SEGMENTS):
        chain = [_segment_mask(start + k) for k in range(equal + loose)]
        for left_out in range(equal, equal + max(loose, 1)):
            masks.append((start, sum(m for k, m in enumerate(chain) if k != left_out)))
    return masks


def finer_masks(mask: int, distance: int) -> list[int]:
    """The mask with each of ``distance`` + 1 even parts of the bits that it leaves open added in turn."""
    still_open = [b for b in range(BITS) if not mask >> b & 1]
    return [mask | sum(1 << b for b in part.tolist()) for part in np.array_split(np.array(still_open, object), distance + 1) if len(part)]


def _keyed(rows: DataFrame, masks: Column) -> DataFrame:
    """``(fp, start, mask, key)`` for an array of ``(start, mask)`` per row; the key stands for the bits under the mask."""
    spread = rows.select("fp", F.explode(masks).alias("m")).select("fp", "m.start", "m.mask")
    return spread.withColumn("key", F.xxhash64("start", "mask", F.col("fp").bitwiseAND(F.col("mask"))))


def shared_keys(fps: DataFrame, distance: int) -> DataFrame:
    """``(key, start, fp)`` of all keys that 2 to ``CROWD`` of the distinct ``fps(fp)`` share."""
    heads = [F.struct(F.lit(s).alias("start"), F.lit(_signed(m)).alias("mask")) for s, m in head_masks(distance)]
    keyed, found = _keyed(fps, F.array(*heads)), []
    while True:
        sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        shared = cut_lineage(keyed.join(sizes, "key"))
        found.append(shared.where(F.col("size") <= CROWD).select("key", "start", "fp"))
        crowded = shared.where(F.col("size") > CROWD)
        if crowded.isEmpty():
            break
        # At most 24 masks to begin with and four times as many in each round, whatever the input.
        table = [
            (row["start"], row["mask"], [_signed(m) for m in finer_masks(row["mask"] % (1 << BITS), distance)])
            for row in crowded.select("start", "mask").distinct().collect()
        ]
        named = F.broadcast(crowded.sparkSession.createDataFrame(table, "start int, mask bigint, finer array<bigint>"))
        finer = F.transform("finer", lambda m: F.struct(F.col("start").alias("start"), m.alias("mask")))
        keyed = _keyed(crowded.join(named, ["start", "mask"]), finer).distinct()
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole


def close_pairs(key: np.ndarray, start: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs with one key whose chains stay within their budgets; equal keys stand side by side."""
    budgets = chain_budgets(distance)
    turn = (start * WIDTH).astype(np.uint64)
    back = (np.uint64(BITS) - turn) % np.uint64(BITS)
    left, right = [], []
    rows, gap = np.arange(len(key) - 1), 1
    while len(rows := rows[rows + gap < len(key)]) and len(rows := rows[key[rows] == key[rows + gap]]):
        differ = fp[rows] ^ fp[rows + gap]
        ring = (differ << turn[rows]) | (differ >> back[rows])
        kept, spent = np.arange(len(rows)), np.zeros(len(rows), np.int64)
        for segment, budget in enumerate(budgets):
            bits = (ring[kept] >> np.uint64(BITS - WIDTH * (segment + 1))) & np.uint64((1 << WIDTH) - 1)
            spent = spent + np.bitwise_count(bits)
            alive = spent <= budget
            kept, spent = kept[alive], spent[alive]
        left.append(rows[kept])
        right.append(rows[kept] + gap)
        gap += 1
    return np.concatenate(left or [np.empty(0, int)]), np.concatenate(right or [np.empty(0, int)])


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from each node to the least node of its component, for undirected links of numbers."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = places[: len(a)], places[len(a) :]
    least = np.arange(len(nodes))
    while True:
        new = least.copy()
        np.minimum.at(new, least[x], least[y])
        np.minimum.at(new, least[y], least[x])
        new = new[new]
        if (new == least).all():
            break
        least = new
    moved = np.flatnonzero(least != np.arange(len(nodes)))
    return nodes[least[moved]], nodes[moved]


def links(keys: DataFrame, distance: int) -> DataFrame:
    """``(a, b)``: a spanning forest of the pairs within the distance, from ``(key, start, fp)``."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size < _ROWS:
                continue
            rows = pd.concat(held, ignore_index=True)
            # The last key may go on in the next batch; it has CROWD rows at most.
            cut = int(np.searchsorted(rows["key"].to_numpy(), rows["key"].iloc[-1]))
            yield _forest_of(rows.iloc[:cut], distance)
            held = [rows.iloc[cut:]]
            size = len(held[0])
        if size:
            yield _forest_of(pd.concat(held, ignore_index=True), distance)

    dealt = keys.repartition("key").sortWithinPartitions("key")
    return dealt.mapInPandas(compare, "a bigint, b bigint").distinct()


def _forest_of(rows: pd.DataFrame, distance: int) -> pd.DataFrame:
    fp = rows["fp"].to_numpy().astype(np.uint64)
    x, y = close_pairs(rows["key"].to_numpy(), rows["start"].to_numpy(), fp, distance)
    a, b = forest(fp[x].astype(np.int64), fp[y].astype(np.int64))
    return pd.DataFrame({"a": a, "b": b})


def near_duplicates(docs: DataFrame, width: int = 5, distance: int = 3) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id, kept``.

    ``fingerprint`` has 16 lowercase hex digits. Documents are linked if their fingerprints differ in at most
    ``distance`` bits (0 to 3); ``component_id`` is the smallest doc_id that links reach, ``kept`` says that it is the
    row's own.
    """
    if not 0 <= distance <= MOST_DISTANCE:
        raise ValueError(f"the distance must be 0 to {MOST_DISTANCE} bits")
    marked = cut_lineage(sketch(docs, width))
    nodes = cut_lineage(marked.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")))
    named = nodes.withColumnRenamed("first", "component_id")
    if distance:
        comps = components(links(shared_keys(nodes.select("fp"), distance), distance))
        placed = nodes.join(comps.withColumnRenamed("id", "fp"), "fp", "left")
        placed = cut_lineage(placed.select("fp", "first", "n", F.coalesce("component", "fp").alias("component")))
        least = placed.groupBy("component").agg(F.min("first").alias("component_id"))
        named = placed.join(least, "component").select("fp", "component_id", "n")
    return _looked_up(marked, cut_lineage(named))


def _looked_up(marked: DataFrame, named: DataFrame) -> DataFrame:
    """Each document with its component; fingerprints of very many rows are broadcast, so no task has all of one."""
    total = named.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") > total / HOT_SHARE
    hot, rest = F.broadcast(named.where(is_hot).select("fp", "component_id")), named.where(~is_hot).select("fp", "component_id")
    found = marked.join(hot, "fp").unionByName(marked.join(hot.select("fp"), "fp", "left_anti").join(rest, "fp"))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), BITS // 4, "0")).alias("fingerprint"),
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )

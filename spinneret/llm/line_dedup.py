"""Operator 2: line deduplication by a deletion-neighbourhood join.

Two lines are near-equal if one edit (a code point replaced, inserted or left out) leads from one to the other. Then
they have a common variant: both lose the replaced code point, or the longer one loses the extra one. So every line
emits the hashes of its variants, equal variants are joined, and the edit distance is verified on what has met.

Links stay linear in the lines. Lines that lose a code point at the same place and are then equal are all one edit from
each other, so each is linked with the least of them; a line that is itself another's variant is linked with that one.

A line has as many variants as code points. To emit them only where they can meet, two coarser hashes go first, which
lose no pair: an edit lies in one half of a line, so the other half is equal; and of ``BLOCKS`` parts all but one are.
Only lines that share a half with another distinct line go on, and then only with the parts that may hold the edit.

Of all near-equal lines, linked directly or through others, the earliest stays: by doc_id, then by place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinneret.llm.common import ROW, components, packed, with_row
from spinneret.llm.shingles import mix
from spinneret.session import cut_lineage

#: Shorter lines are compared for equality only, since one edit can change what they say.
MIN_CHARS = 10
BLOCKS = 8
#: Lines whose hashes are broadcast to fetch their texts, 16 bytes each.
SMALL_LINES = 1 << 20
_BASE = np.uint64(0x5851F42D4C957F2D)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def numbered_lines(docs: DataFrame) -> DataFrame:
    """``(_row, doc_id, line_no, line, h1, h2)`` of every line that is not blank; ``docs`` is a table scan.

    A line is what lies between two ``\\n``; its number counts all lines of the document from 0.
    """
    rows = with_row(docs.select("doc_id", "text")).select(ROW, "doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    rows = rows.where(F.trim("line", F.lit(" \t\r\x0b\x0c")) != "")
    return rows.select("*", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("second"), "line").alias("h2"))


def _half_keys() -> F.Column:
    """Hashes of the first and the last half, for the line's own length and for a partner that is one shorter."""
    keys = []
    for shorter in (0, 1):
        m = F.col("n_chars") - shorter
        first = F.expr(f"substring(line, 1, int((n_chars - {shorter}) div 2))")
        last = F.expr(f"right(line, int(n_chars - {shorter} - (n_chars - {shorter}) div 2))")
        keys += [F.xxhash64(F.lit("first"), m, first), F.xxhash64(F.lit("last"), m, last)]
    return F.array(*keys)


def distinct_lines(lines: DataFrame) -> DataFrame:
    """``(h1, h2, first, n, keys)``: the earliest occurrence, the number of occurrences and the half keys of each line."""
    told = lines.withColumn("n_chars", F.length("line"))
    keys = F.when(F.col("n_chars") >= MIN_CHARS, _half_keys()).otherwise(F.array().cast("array<bigint>"))
    told = told.select("h1", "h2", _occurrence().alias("first"), keys.alias("keys"))
    return told.groupBy("h1", "h2").agg(F.min("first").alias("first"), F.count(F.lit(1)).alias("n"), F.first("keys").alias("keys"))


def _occurrence() -> F.Column:
    """The place of a line, in an order that has lines of documents without an id last."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW, "line_no")


class _Hashed:
    """Running sums over a line, from which the hash of any two pieces put together is read off."""

    def __init__(self, line: str) -> None:
        points = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        self.n = len(points)
        powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(self.n, _BASE, np.uint64)]))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(points * powers[:-1])])

    def without(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """The hashes of the line without the code points from each start to its stop."""
        shifts = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(int((stops - starts).max()), _UNBASE, np.uint64)]))
        return mix(self.sums[starts] + (self.sums[self.n] - self.sums[stops]) * shifts[stops - starts])

    def without_one(self, places: np.ndarray) -> np.ndarray:
        return mix(self.sums[places] + (self.sums[self.n] - self.sums[places + 1]) * _UNBASE)


def _tagged(hashed: np.ndarray, *tags: int | np.ndarray) -> np.ndarray:
    """The hash together with what else has to be equal, as signed numbers."""
    out = hashed
    for tag in tags:
        out = mix(out + mix(np.atleast_1d(np.asarray(tag, np.uint64)) + np.uint64(0x632BE59BD9B4E019)))
    return out.astype(np.int64)


def _block_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For both lengths a partner may have, the hash of the line without each of its parts."""
    part = np.arange(BLOCKS)
    for batch in batches:
        found = []
        for number, line in zip(batch["number"], batch["line"]):
            hashed = _Hashed(line)
            for m in (hashed.n, hashed.n - 1):
                low, high = m * part // BLOCKS, m * (part + 1) // BLOCKS
                key = _tagged(hashed.without(low, high + (hashed.n - m)), m, part)
                found.append(np.stack([key, np.full(BLOCKS, number), np.full(BLOCKS, m), low, high], axis=1))
        if found:
            yield pd.DataFrame(np.concatenate(found), columns=["key", "number", "m", "low", "high"])


def _variants(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The deletion neighbourhood inside the parts that may hold an edit.

    ``side`` is 0 for lines that lose a code point at a place, 1 for lines that lose one anywhere, 2 for whole lines.
    """
    for batch in batches:
        keys, numbers, sides = [], [], []
        for number, line, parts in zip(batch["number"], batch["line"], batch["parts"]):
            hashed = _Hashed(line)
            same = [np.arange(p["low"], p["high"]) for p in parts if p["m"] == hashed.n]
            longer = [np.arange(p["low"], p["high"] + 1) for p in parts if p["m"] < hashed.n]
            found = []
            if same:
                places = np.unique(np.concatenate(same))
                found.append((_tagged(hashed.without_one(places), places, 0), 0))
                found.append((_tagged(hashed.without(np.zeros(1, np.int64), np.zeros(1, np.int64)), 1), 2))
            if longer:
                places = np.unique(np.concatenate(longer))
                found.append((np.unique(_tagged(hashed.without_one(places), 1)), 1))
            for key, side in found:
                keys.append(key)
                numbers.append(np.full(len(key), number))
                sides.append(np.full(len(key), side))
        if keys:
            yield pd.DataFrame({"key": np.concatenate(keys), "number": np.concatenate(numbers), "side": np.concatenate(sides)})


def within_one_edit(one: str, other: str) -> bool:
    short, long = sorted((one, other), key=len)
    if len(long) - len(short) > 1:
        return False
    at = 0
    while at < len(short) and short[at] == long[at]:
        at += 1
    return short[at + (len(short) == len(long)) :] == long[at + 1 :]


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch.loc[[within_one_edit(x, y) for x, y in zip(batch["line_a"], batch["line_b"])], ["a", "b"]]


def line_links(texts: DataFrame) -> DataFrame:
    """``(a, b)``: verified links between the numbers of ``texts(number, line)``, enough to connect all near-equal lines."""
    coarse = texts.mapInPandas(_block_keys, "key bigint, number bigint, m bigint, low bigint, high bigint")
    met = coarse.groupBy("key").agg(F.min("number").alias("x"), F.max("number").alias("y")).where("x < y").select("key")
    parts = coarse.join(met, "key").groupBy("number").agg(F.collect_set(F.struct("m", "low", "high")).alias("parts"))
    variants = cut_lineage(texts.join(parts, "number").mapInPandas(_variants, "key bigint, number bigint, side int"))
    replaced = variants.where("side = 0")
    least = replaced.groupBy("key").agg(F.min("number").alias("a"), F.max("number").alias("z")).where("a < z").select("key", "a")
    by_place = replaced.join(least, "key").where("number <> a").select("a", F.col("number").alias("b"))
    whole = variants.where("side = 2").select("key", F.col("number").alias("a"))
    shortened = variants.where("side = 1").join(whole, "key").select("a", F.col("number").alias("b"))
    pairs = by_place.unionByName(shortened).distinct()
    joined = pairs.join(texts.select(F.col("number").alias("a"), F.col("line").alias("line_a")), "a")
    joined = joined.join(texts.select(F.col("number").alias("b"), F.col("line").alias("line_b")), "b")
    return joined.select("a", "b", "line_a", "line_b").mapInPandas(_verified, "a bigint, b bigint")


def line_classes(docs: DataFrame) -> DataFrame:
    """``(h1, h2, earliest)`` of every line that occurs more than once or has a near-equal line."""
    lines = numbered_lines(docs)
    known = cut_lineage(distinct_lines(lines))
    keyed = known.select("h1", "h2", F.explode("keys").alias("key"))
    met = keyed.groupBy("key").agg(F.min("h1").alias("x"), F.max("h1").alias("y")).where("x < y").select("key")
    flagged = cut_lineage(keyed.join(met, "key").select("h1", "h2").distinct())
    small = F.broadcast(flagged) if flagged.count() <= SMALL_LINES else flagged
    texts = lines.join(small, ["h1", "h2"], "left_semi").groupBy("h1", "h2").agg(F.min("line").alias("line"))
    # The checkpoint fixes the numbers.
    texts = cut_lineage(texts.withColumn("number", F.monotonically_increasing_id()))
    classes = components(line_links(texts.select("number", "line")))
    members = texts.select("h1", "h2", "number").join(classes, F.col("number") == F.col("id")).select("h1", "h2", "component")
    members = members.join(known.select("h1", "h2", "first"), ["h1", "h2"])
    earliest = members.groupBy("component").agg(F.min("first").alias("earliest"))
    near = members.join(earliest, "component").select("h1", "h2", "earliest")
    repeated = known.where("n > 1").join(near, ["h1", "h2"], "left_anti").select("h1", "h2", F.col("first").alias("earliest"))
    return near.unionByName(repeated)


def removed_lines(docs: DataFrame) -> DataFrame:
    """``(_row, removed)``: the numbers of the lines to remove from each row that has any, ascending."""
    classes = cut_lineage(line_classes(docs))
    lines = numbered_lines(docs).select("h1", "h2", _occurrence().alias("place"))
    late = lines.join(classes, ["h1", "h2"]).where("place <> earliest")
    return late.groupBy(F.col(f"place.{ROW}").alias(ROW)).agg(F.sort_array(F.collect_list("place.line_no")).alias("removed"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """All columns, with ``text`` without the removed lines. ``docs`` is a table scan; a null text stays null."""
    joined = packed(docs).join(removed_lines(docs), ROW, "left")
    kept = F.array_join(F.filter(F.split("doc.text", "\n"), lambda x, i: ~F.array_contains("removed", i)), "\n")
    text = F.when(F.col("removed").isNull(), F.col("doc.text")).otherwise(kept).alias("text")
    return joined.select(*[text if c == "text" else f"doc.{c}" for c in docs.columns])


def line_digest(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_lines, n_removed, removed``, the last as line numbers joined by commas.

    ``n_lines`` counts all lines, blank ones too; a null text has none. Repeated rows are later occurrences of the
    first one, so all their lines go. Blank lines always stay. Extra columns play no part.
    """
    own = with_row(docs.select("doc_id", "text")).select(ROW, "doc_id", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("bigint").alias("n_lines"))
    own = own.withColumn("n_lines", F.greatest("n_lines", F.lit(0)))
    joined = own.join(removed_lines(docs), ROW, "left")
    return joined.select(
        "doc_id", "n_lines", F.coalesce(F.size("removed"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce(F.array_join(F.col("removed").cast("array<string>"), ","), F.lit("")).alias("removed"),
    )


#: The same as :func:`line_digest`: lines that share a half are compared by their common prefix and suffix.
LINES_SQL = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents
), o AS (
  SELECT doc_id, unnest(range(len(parts))) AS line_no, unnest(parts) AS line FROM t
), f AS (
  SELECT line, min(struct_pack(doc_id := doc_id, line_no := line_no)) AS first, length(line) AS n
  FROM o WHERE trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) <> '' GROUP BY line
), g AS (
  SELECT row_number() OVER () AS id, * FROM f
), k AS (
  SELECT id, line, n, m, 'f' AS side, left(line, m // 2) AS part FROM (SELECT *, unnest([n, n - 1]) AS m FROM g WHERE n >= 10)
  UNION ALL
  SELECT id, line, n, m, 'l', right(line, m - m // 2) FROM (SELECT *, unnest([n, n - 1]) AS m FROM g WHERE n >= 10)
), c AS (
  SELECT DISTINCT x.id AS a, y.id AS b, x.line AS la, y.line AS lb, x.n AS na, y.n AS nb
  FROM k x JOIN k y ON x.m = y.m AND x.side = y.side AND x.part = y.part AND x.id < y.id
), d AS (
  SELECT a, b, greatest(na, nb) AS longest, least(na, nb) AS shortest,
    coalesce(list_position(list_transform(range(1, least(na, nb) + 1), lambda i: la[i] = lb[i]), false) - 1, least(na, nb)) AS prefix,
    coalesce(list_position(list_transform(range(1, least(na, nb) + 1), lambda i: reverse(la)[i] = reverse(lb)[i]), false) - 1, least(na, nb)) AS suffix
  FROM c
), l AS (
  SELECT a, b FROM d WHERE prefix + least(suffix, shortest - prefix) >= longest - 1
), u AS (
  SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r AS (
  SELECT id, id AS reached FROM g UNION SELECT r.id, u.b FROM r JOIN u ON u.a = r.reached
), e AS (
  SELECT r.id, min(g.first) AS earliest FROM r JOIN g ON g.id = r.reached GROUP BY r.id
), x AS (
  SELECT o.doc_id, o.line_no FROM o JOIN g USING (line) JOIN e USING (id)
  WHERE struct_pack(doc_id := o.doc_id, line_no := o.line_no) <> e.earliest
), s AS (
  SELECT doc_id, count(*) AS n, string_agg(line_no, ',' ORDER BY line_no) AS removed FROM x GROUP BY doc_id
)
SELECT doc_id, coalesce(len(parts), 0)::BIGINT AS n_lines, coalesce(n, 0)::BIGINT AS n_removed, coalesce(removed, '') AS removed
FROM t LEFT JOIN s USING (doc_id)
"""

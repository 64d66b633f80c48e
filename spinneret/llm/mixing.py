"""Operator 3: a mix of sources with target weights and a curriculum that changes over the training.

Each source gets a target number of words. Inside a source the documents lie end to end in a hashed order, pass after
pass, so a copy of a document covers an interval of its source's words. A weight schedule says how the source's share
changes over the training time 0..1; its integral is the demand for the source's words up to a time. Inverting that
demand at the middle of a copy's interval gives the time at which the copy is due. Sorting all copies by that time in
ranges lays out the whole training.

Everything is DataFrame and SQL functions. Running totals come from range partitions on (source, hash), so a source
that holds most rows is spread over many tasks. Sources are broadcast while there are at most ``SMALL_SOURCES``, else
joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinneret.llm.common import ROW, WORD, packed, with_row
from spinneret.operators.ordering import in_ranges, rank_rows, running_sum
from spinneret.session import cut_lineage

WEIGHTS = (3, 1, 2)
SHARE = 1.5
#: A target is at most so many times its source's size, and a document is taken at most so often.
MOST = 2
#: Weights at equally spaced times, one schedule after the other for the sources in order.
SCHEDULES = ((1.5, 1.0, 0.5), (1.0, 1.0, 1.0), (0.5, 1.0, 1.5))
SMALL_SOURCES = 100_000


def _due(x: str, schedules: Sequence[Sequence[float]]) -> str:
    """SQL text: the time at which the share ``x`` of a source's demand is reached, for the schedule ``schedule``.

    Inside a piece of a schedule the weight is linear, so the demand is quadratic; the root is in its stable form.
    """
    cases = []
    for number, weights in enumerate(schedules):
        step = 1.0 / (len(weights) - 1)
        areas = [(a + b) / 2 * step for a, b in zip(weights, weights[1:])]
        total, done = sum(areas), 0.0
        for k, area in enumerate(areas):
            low, slope = weights[k] / total, (weights[k + 1] - weights[k]) / step / total
            last = k == len(areas) - 1
            upto = "" if last else f" AND {x} <= {done + area / total!r}D"
            rest = f"({x} - {done!r}D)"
            root = f"({low!r}D + sqrt(greatest(0D, {low * low!r}D + {2 * slope!r}D * {rest})))"
            cases.append(f"WHEN schedule = {number}{upto} THEN {k * step!r}D + if({rest} <= 0D, 0D, 2D * {rest} / {root})")
            done += area / total
    return f"least(1D, CASE {' '.join(cases)} END)"


def source_targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST, n_schedules: int = len(SCHEDULES)) -> DataFrame:
    """``(source, source_size, start, target, schedule)`` from ``(source, source_size)``; one row per source.

    ``start`` counts the words of all sources before it. The targets are ``least(most * size, level * weight)`` at the
    level where they sum up to ``share`` of all words: what is left when the excess of full sources has been shared
    out again until no source is above. A level is tried at each source, full sources before it in the order of
    ``size / weight``; too many full sources give a level that is too low, so the highest consistent one is right.
    """
    named = sources.withColumn("_none", F.col("source").isNull())
    ranked = rank_rows(running_sum(in_ranges(named, "_none", "source"), "source_size", "start"), "_rank")
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = ranked.select(
        "source", "source_size", "start", "_rank", turn.cast("bigint").alias("_weight"),
        (F.col("source_size") * most).alias("_cap"), (F.col("_rank") % n_schedules).cast("int").alias("schedule"),
    )
    ranked = cut_lineage(ranked.withColumn("_ratio", F.col("_cap") / F.col("_weight")))
    totals = ranked.agg(F.sum("source_size").alias("words"), F.sum("_weight").alias("weight")).first()
    if totals["words"] is None:
        return ranked.select("source", "source_size", "start", F.lit(0.0).alias("target"), "schedule")
    order = in_ranges(ranked, "_ratio", "_rank")
    order = running_sum(running_sum(order, "_cap", "_full"), "_weight", "_used")
    level = (F.lit(share * totals["words"]) - F.col("_full")) / (F.lit(totals["weight"]) - F.col("_used"))
    highest = order.select(level.alias("level"), "_ratio").where("level <= _ratio").agg(F.max("level")).first()[0]
    full = F.col("_cap").cast("double")
    target = full if highest is None else F.least(full, F.lit(highest) * F.col("_weight"))
    return ranked.select("source", "source_size", "start", target.alias("target"), "schedule")


def plan_mix(rows: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST, schedules: Sequence[Sequence[float]] = SCHEDULES, seed: int = 0) -> DataFrame:
    """``rows`` of ``(doc_id, source, size, ...)`` with ``source_size``, ``target``, ``positions`` and ``taken``.

    ``positions`` holds the time of each copy in ascending passes, and is empty where the document is left out; a copy
    is in the mix if its middle lies before its source's target, so a source's words miss the target by half a document
    at most. ``taken`` is the copies' words. A null source is a source of its own, the last one; rows without words
    take no words; repeated rows are rows of their own. Documents are laid in the order of a hash of ``doc_id``, then
    ``doc_id`` and ``size``, so reruns agree.
    """
    keep = rows.columns
    keyed = rows.withColumns({
        "_none": F.col("source").isNull(),
        "_order": F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))),
    })
    ranged = in_ranges(keyed, "_none", "source", "_order", "doc_id", "size")
    placed = running_sum(ranged, "size", "_offset")
    sources = cut_lineage(ranged.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size")))
    targets = cut_lineage(source_targets(sources, weights, share, most, len(schedules)).withColumnRenamed("source", "_source"))
    if targets.count() <= SMALL_SOURCES:
        targets = F.broadcast(targets)
    joined = placed.join(targets, F.col("source").eqNullSafe(F.col("_source")))
    offset = "(_offset - start + pass * source_size)"
    due = _due("p", schedules)
    positions = (
        f"transform(transform(filter(sequence(0L, {most - 1}L), pass -> 2 * {offset} + size <= 2D * target),"
        f" pass -> if(target > 0D, ({offset} + size / 2D) / target, 0D)), p -> {due})"
    )
    planned = joined.withColumn("positions", F.expr(positions))
    taken = (F.size("positions") * F.col("size")).cast("bigint")
    return planned.select(*keep, "source_size", "target", "positions", taken.alias("taken"))


def n_words(text: str = "text") -> F.Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def mix_table(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: every column of a table scan, a row per copy, with ``position``, in the order of training.

    Row numbers, sources and sizes are planned; the texts are joined to their copies and sorted into ranges, two
    exchanges of what the mix takes. ``docs`` must be a scan; ``position`` replaces a column of that name.
    """
    keep = [f"doc.{c}" for c in docs.columns if c != "position"]
    plan = plan_mix(with_row(docs.select("doc_id", "source", n_words().alias("size"))), **settings)
    copies = packed(docs).join(plan.select(ROW, F.explode("positions").alias("position")), ROW)
    return copies.repartitionByRange("position", ROW).sortWithinPartitions("position", ROW).select(*keep, "position")


def mix_digest(docs: DataFrame, **settings) -> DataFrame:
    """One row per document, sorted into ranges by its first position in the training; documents left out come first."""
    plan = plan_mix(docs.select("doc_id", "source", n_words().alias("size")), **settings)
    digest = plan.select(
        "doc_id", "size", "source_size", "target", "taken", F.size("positions").alias("copies"),
        F.array_min("positions").alias("first_position"),
    )
    return digest.repartitionByRange("first_position", "doc_id").sortWithinPartitions("first_position", "doc_id")


#: The same as :func:`mix_digest`, for the default settings.
MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('0|' || coalesce(doc_id::VARCHAR, '')) AS o
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT source, source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s
), r AS (
  SELECT *, [3, 1, 2][rank % 3 + 1]::BIGINT AS weight, rank % 3 AS schedule,
         (2 * source_size)::DOUBLE / [3, 1, 2][rank % 3 + 1] AS ratio
  FROM w
), k AS (
  SELECT ratio,
         (1.5::DOUBLE * (SELECT sum(source_size) FROM r)::BIGINT - coalesce(sum(2 * source_size) OVER before, 0)::BIGINT)
         / ((SELECT sum(weight) FROM r)::BIGINT - coalesce(sum(weight) OVER before, 0)::BIGINT) AS level
  FROM r WINDOW before AS (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, schedule,
         coalesce(least((2 * source_size)::DOUBLE, (SELECT max(level) FROM k WHERE level <= ratio) * weight), (2 * source_size)::DOUBLE) AS target
  FROM r
), c AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.schedule,
         (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.o, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size)::BIGINT AS offset0
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), n AS (
  SELECT *, (2 * offset0 + size <= 2::DOUBLE * target)::INT + (2 * (offset0 + source_size) + size <= 2::DOUBLE * target)::INT AS copies,
         CASE WHEN target > 0 THEN (offset0 + size / 2::DOUBLE) / target ELSE 0::DOUBLE END AS p
  FROM c
), q AS (
  SELECT *, CASE
      WHEN schedule = 0 AND p <= 0.625 THEN 2 * p / (1.5::DOUBLE + sqrt(2.25::DOUBLE - 2::DOUBLE * p))
      WHEN schedule = 0 THEN 0.5::DOUBLE + 2 * (p - 0.625::DOUBLE) / (1::DOUBLE + sqrt(1::DOUBLE - 2::DOUBLE * (p - 0.625::DOUBLE)))
      WHEN schedule = 1 AND p <= 0.5 THEN 2 * p / (1::DOUBLE + sqrt(1::DOUBLE))
      WHEN schedule = 1 THEN 0.5::DOUBLE + 2 * (p - 0.5::DOUBLE) / (1::DOUBLE + sqrt(1::DOUBLE))
      WHEN p <= 0.375 THEN 2 * p / (0.5::DOUBLE + sqrt(0.25::DOUBLE + 2::DOUBLE * p))
      ELSE 0.5::DOUBLE + 2 * (p - 0.375::DOUBLE) / (1::DOUBLE + sqrt(1::DOUBLE + 2::DOUBLE * (p - 0.375::DOUBLE)))
    END AS due
  FROM n
)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, copies::INT AS copies,
       CASE WHEN copies > 0 THEN least(1::DOUBLE, due) END AS first_position
FROM q
"""

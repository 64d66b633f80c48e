"""Rounds of a crawl over document ids.

The state of 64 consecutive ids is one row of bit masks: which ids were ever queued, which are due for their first,
second, ... attempt in this round, and which fail that attempt. So a round moves and rewrites a few bits for each id,
whatever the length of the URLs. Ids leave the masks only to look up their links, and go back into masks map-side.

A round's attempts that succeed bring in their links' targets for the next round, those that fail are queued again behind
them, up to the last attempt. Each round is one job with one shuffle, which writes the next state as a numbered folder;
the number of queued ids is observed on the way. A lost executor costs the tasks it had, a failed round its own folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from spinneret.session import cut_lineage, drop_buckets, in_buckets, scratch_path

#: Ids of one mask.
WORD = 64
# Rows of ids that may be broadcast, of 8 bytes each.
SMALL_TABLE = 100_000


class Edges:
    """Links laid out once for all rounds: looking up a frontier does not move them again.

    Sources with an ordinary number of links lie in hash buckets. A source with more than its share of one bucket would
    make that bucket's task too long; there are at most as many of those as buckets. Their links stay in evenly filled
    partitions, and the few that are in the frontier are broadcast to them.
    """

    def __init__(self, edges: DataFrame):
        """Takes ``(src, dst)`` that are cheap to read again."""
        buckets = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        n_edges, self.has_large = edges.count(), False
        share = max(n_edges / buckets, SMALL_TABLE)
        if n_edges > share:
            degrees = edges.groupBy("src").agg(F.count(F.lit(1)).alias("n"))
            self.large = cut_lineage(degrees.where(F.col("n") > share).select("src"))
            self.has_large = not self.large.isEmpty()
        if self.has_large:
            self.large_edges = cut_lineage(edges.join(F.broadcast(self.large), "src", "left_semi"))
            edges = edges.join(F.broadcast(self.large), "src", "left_anti")
        self.name, self.bucketed = in_buckets(edges, "src")

    def of(self, sources: DataFrame, size: int) -> DataFrame:
        """The links ``(src, dst)`` of ``sources(src)``, which has at most ``size`` rows."""
        found = self.bucketed.join(F.broadcast(sources) if size <= SMALL_TABLE else sources, "src", "left_semi")
        if self.has_large:
            few = sources.join(F.broadcast(self.large), "src", "left_semi")
            found = found.unionByName(self.large_edges.join(F.broadcast(few), "src", "left_semi"))
        return found


def _due(k: int) -> str:
    """The mask of ids that are due for attempt ``k``, from 1 on."""
    return f"due_{k}"


def _fails(k: int) -> str:
    return f"fails_{k}"


def _schema(attempts: int) -> str:
    names = ["seen", *map(_due, range(1, attempts + 1)), *map(_fails, range(1, attempts + 1))]
    return ", ".join(["word bigint", *(f"{n} bigint" for n in names), "open bigint"])


def _bit(ids: str = "id") -> str:
    return f"shiftleft(1L, cast({ids} % {WORD} AS int))"


def _ids(mask: str) -> str:
    """The ids in a mask of ``word``, as an array."""
    return f"transform(filter(sequence(0, {WORD - 1}), i -> getbit({mask}, i) = 1), i -> word * {WORD} + i)"


def _masks(ids: DataFrame, **conditions: str) -> DataFrame:
    """``(word, ...)`` with a mask for each condition of the ``ids(id, ...)`` that meet it; combined map-side."""
    made = [F.expr(f"bit_or(CASE WHEN {condition} THEN {_bit()} END)").alias(name) for name, condition in conditions.items()]
    return ids.groupBy(F.expr(f"id div {WORD}").alias("word")).agg(*made)


def _after(attempts: int) -> list[str]:
    """The state after a round, from the state before it and the mask ``found``; null masks are empty.

    New ids are due for their first attempt, failed ones for their next.
    """
    def mask(name: str) -> str:
        return f"coalesce({name}, 0L)"

    due = {1: f"({mask('found')} & ~{mask('seen')})"}
    due |= {k + 1: f"({mask(_due(k))} & {mask(_fails(k))})" for k in range(1, attempts)}
    n_open = " + ".join(f"bit_count({d})" for d in due.values())
    return [
        "word", f"{mask('seen')} | {mask('found')} AS seen", *(f"{d} AS {_due(k)}" for k, d in due.items()),
        *(f"{mask(_fails(k))} AS {_fails(k)}" for k in range(1, attempts + 1)), f"cast({n_open} AS bigint) AS open",
    ]


def walk(
    edges: DataFrame, seeds: DataFrame, failures: DataFrame | None = None, retries: int = 0, max_rounds: int | None = None
) -> DataFrame:
    """``(id, hop, attempts, state)`` of all ids that are queued, from ``edges(src, dst)`` and ``seeds(id)``.

    ``failures(id, n)`` says how many attempts fail before one succeeds, for ids with any. ``hop`` is the round that first
    queues an id; it is fetched after ``n`` more rounds, or given up after ``retries`` more. Rounds after number
    ``max_rounds`` are left out; who waits for another attempt then is ``pending``.
    """
    spark, attempts = edges.sparkSession, retries + 1 if failures is not None else 1
    laid_out = Edges(edges)
    try:
        folder, last = _run(laid_out, seeds, failures, attempts, max_rounds, scratch_path(spark, "crawl"))
    finally:
        drop_buckets(spark, laid_out.name)
    rounds = _read(spark, folder, f"{_schema(attempts)}, round int").where("open > 0").where(F.col("round") <= last)
    told = []
    for k in range(1, attempts + 1):
        gone = F.lit("given_up") if k == attempts else F.when(F.col("round") == last, F.lit("pending"))
        for mask, state in (
            (F.col(_due(k)).bitwiseAND(F.bitwise_not(_fails(k))), F.lit("fetched")), (F.col(_due(k)).bitwiseAND(F.col(_fails(k))), gone),
        ):
            told.append(F.struct(mask.alias("mask"), F.lit(k).alias("attempts"), state.alias("state")))
    fates = rounds.select("word", "round", F.explode(F.array(*told)).alias("t")).where("t.mask <> 0 AND t.state IS NOT NULL")
    hop = (F.col("round") - F.col("t.attempts") + 1).alias("hop")
    return fates.select(F.explode(F.expr(_ids("t.mask"))).alias("id"), hop, "t.attempts", "t.state")


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def _write_counted(state: DataFrame, path: str) -> int:
    """Write a state and return how many ids are due in it."""
    seen = Observation()
    state.observe(seen, F.sum("open").alias("open")).write.parquet(path)
    return seen.get["open"] or 0


def _run(edges: Edges, seeds: DataFrame, failures: DataFrame | None, attempts: int, max_rounds: int | None, folder: str) -> tuple[str, int]:
    """Write the states of all rounds; returns their folder and the number of the last round that had anything due."""
    spark, schema, after = seeds.sparkSession, _schema(attempts), _after(attempts)
    masks = [c.split()[0] for c in schema.split(", ")][1:-1]
    joined = [F.bit_or(m).alias(m) for m in ("found", *masks)]
    state = _masks(seeds, found="true").selectExpr("word", "found", *(f"cast(NULL AS bigint) AS {m}" for m in masks))
    if failures is not None:
        failing = _masks(failures, **{_fails(k): f"n >= {k}" for k in range(1, attempts + 1)})
        state = state.unionByName(failing, allowMissingColumns=True).groupBy("word").agg(*joined)
    number, n_open = 0, _write_counted(state.selectExpr(*after), f"{folder}/round=0")
    succeeds = " | ".join(f"({_due(k)} & ~{_fails(k)})" for k in range(1, attempts + 1))
    fetched = f"explode({_ids(f'({succeeds})')}) AS src"
    found = [f"dst div {WORD} AS word", f"{_bit('dst')} AS found", *(f"cast(NULL AS bigint) AS {m}" for m in masks)]
    held = ["word", "cast(NULL AS bigint) AS found", *masks]
    while n_open and (max_rounds is None or number < max_rounds):
        state = _read(spark, f"{folder}/round={number}", schema)
        # The state and what was found meet in one aggregate; equal targets are one bit before they are shuffled.
        targets = edges.of(state.selectExpr(fetched), n_open).selectExpr(*found)
        met = state.selectExpr(*held).union(targets).groupBy("word").agg(*joined).selectExpr(*after)
        n_due = _write_counted(met, f"{folder}/round={number + 1}")
        if not n_due:
            break
        n_open, number = n_due, number + 1
    return folder, number

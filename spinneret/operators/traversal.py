"""Crawl traversal over tables: visited set, reachability, retry decisions, outcomes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spinneret.operators.documents import build_doc_table
from spinneret.operators.links import distinct_targets
from spinneret.operators.ordering import dense_rank
from spinneret.operators.rounds import SMALL_TABLE, walk
from spinneret.session import cut_lineage

# --- Fixed value: attempts after the first failure ------------------------------------------------------------------
RETRIES = 3
# --------------------------------------------------------------------------------------------------------------------

def dequeue_unvisited(queue: DataFrame, visited: DataFrame) -> DataFrame:
    """``(url)``: each queued URL once, without those visited before."""
    return queue.select("url").distinct().join(visited.select("url"), "url", "left_anti")


def reachable(links: DataFrame, seeds: DataFrame, max_hops: int | None = None) -> DataFrame:
    """``(url, hop)`` for all URLs that can be reached over ``(src_url, dst_url)``, with the least number of hops.

    URLs are numbered once; the rounds then know ids only.
    """
    sides = links.select(F.col("src_url").alias("url")).unionByName(links.select(F.col("dst_url").alias("url")))
    urls = sides.unionByName(seeds.select("url")).where("url IS NOT NULL").distinct()
    ids = cut_lineage(dense_rank(urls, "url", out="id"))
    sources = ids.select(F.col("url").alias("src_url"), F.col("id").alias("src"))
    targets = ids.select(F.col("url").alias("dst_url"), F.col("id").alias("dst"))
    edges = links.where("src_url <> dst_url").join(targets, "dst_url").join(sources, "src_url").select("src", "dst")
    seen = walk(cut_lineage(edges), seeds.join(ids, "url").select("id"), max_rounds=max_hops)
    return seen.join(ids, "id").select("url", "hop")


def crawl(
    pages: DataFrame, seeds: DataFrame, max_hops: int | None = None, log: DataFrame | None = None, retries: int = RETRIES
) -> DataFrame:
    """``(url, hop, attempts, state)`` of all URLs that a crawl of the snapshot visits: ``fetched`` or ``given_up``.

    A URL is fetched once, so of several snapshots of it only the first one's links count. A failed fetch goes behind the
    queue and comes back up to ``retries`` times: the n-th attempt at a URL takes the outcome of its n-th row in the fetch
    ``log(url, ts, seq, ok)``, and succeeds if there is none. URLs outside the snapshot fail every time; no links hang on
    them, so they are joined in at the end. ``hop`` is the round that first queues a URL. With ``max_hops`` the rounds
    end early; a URL of the snapshot that waits for another attempt then is ``pending``.

    A page's links are made distinct before they leave it, and their targets are replaced by ids in one join; from there
    on no URL is moved until the result.
    """
    docs = cut_lineage(build_doc_table(pages))
    near = F.broadcast(docs) if docs.count() <= SMALL_TABLE else docs
    targets = near.select(F.col("url").alias("dst_url"), F.col("doc_id").alias("dst"))
    sources = near.select("page_id", F.col("doc_id").alias("src"))
    named = distinct_targets(pages).join(targets, "dst_url", "left")
    placed = cut_lineage(named.select("page_id", "dst", F.when(F.col("dst").isNull(), F.col("dst_url")).alias("url")).join(sources, "page_id"))
    failures = None
    if log is not None:
        failed = retry_ledger(log, retries).where("failures > 0").select("url", F.col("failures").alias("n"))
        failures = failed.join(near.select("url", F.col("doc_id").alias("id")), "url").select("id", "n")
    asked = cut_lineage(seeds.select("url").distinct().join(near.select("url", F.col("doc_id").alias("id")), "url", "left"))
    known = asked.where("id IS NOT NULL").select("id")
    edges = placed.where("dst IS NOT NULL AND dst <> src").select("src", "dst")
    seen = walk(edges, known, failures, retries, max_hops)
    found = seen.join(near.select("url", F.col("doc_id").alias("id")), "id").select("url", "hop", "attempts", "state")
    # A target outside the snapshot is queued in the round after the first page that links to it is fetched.
    fetched = seen.where("state = 'fetched'").select(F.col("id").alias("src"), (F.col("hop") + F.col("attempts")).alias("hop"))
    outside = placed.where("dst IS NULL").select("src", "url").join(fetched, "src").select("url", "hop")
    if max_hops is not None:
        outside = outside.where(F.col("hop") <= max_hops)
    outside = outside.unionByName(asked.where("id IS NULL").select("url", F.lit(0).alias("hop")))
    missing = outside.groupBy("url").agg(F.min("hop").alias("hop"))
    return found.unionByName(missing.select("url", "hop", F.lit(retries + 1).alias("attempts"), F.lit("given_up").alias("state")))


def outcome(visited: DataFrame, pages: DataFrame) -> DataFrame:
    """Add ``state``: a visited URL was fetched, or it was given up and has no document."""
    known = pages.select("url").distinct().withColumn("_known", F.lit(True))
    state = F.when(F.col("_known"), F.lit("fetched")).otherwise(F.lit("given_up"))
    return visited.join(known, "url", "left").withColumn("state", state).drop("_known")


def early_attempts(log: DataFrame, retries: int = RETRIES) -> DataFrame:
    """The attempts that decide a URL's fate: its first success and its first ``retries + 1`` failures.

    The result is a log again. However many attempts a URL has, the rank filter leaves at most ``retries + 1`` of each
    kind per map task before the shuffle.
    """
    in_order = Window.partitionBy("url", "ok").orderBy("ts", "seq")
    ranked = log.select("url", "ts", "seq", "ok", F.row_number().over(in_order).alias("nth")).where(F.col("nth") <= retries + 1)
    return ranked.where(~F.col("ok") | (F.col("nth") == 1))


def retry_ledger(log: DataFrame, retries: int = RETRIES) -> DataFrame:
    """``(url, failures, state, closed_at, closed_seq)`` from ``(url, ts, seq, ok)``.

    A URL closes at its first success (``fetched``) or at failure number ``retries + 1`` (``given_up``), whichever
    comes first; otherwise it is ``pending``. What comes later does not count.
    """
    at = F.struct("ts", "seq")
    nth_failures = [
        F.min(F.when(~F.col("ok") & (F.col("nth") == n), at)).alias(f"failure_{n}") for n in range(1, retries + 2)
    ]
    fates = early_attempts(log, retries).groupBy("url").agg(F.min(F.when(F.col("ok"), at)).alias("first_ok"), *nth_failures)

    def counts(n: int):
        early = F.col("first_ok").isNull() | (F.col(f"failure_{n}") < F.col("first_ok"))
        return (F.col(f"failure_{n}").isNotNull() & early).cast("bigint")

    failures = reduce(lambda total, n: total + counts(n), range(2, retries + 2), counts(1))
    counted = fates.withColumn("failures", failures)
    gave_up = F.col("failures") > retries
    state = F.when(gave_up, F.lit("given_up")).when(F.col("first_ok").isNotNull(), F.lit("fetched"))
    closed = F.when(gave_up, F.col(f"failure_{retries + 1}")).otherwise(F.col("first_ok"))
    return counted.select(
        "url",
        "failures",
        state.otherwise(F.lit("pending")).alias("state"),
        closed.getField("ts").alias("closed_at"),
        closed.getField("seq").alias("closed_seq"),
    )

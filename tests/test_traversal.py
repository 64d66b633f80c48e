import random
from datetime import datetime, timedelta

import pytest

from spinneret.operators import rounds, traversal
from spinneret.operators.traversal import RETRIES, crawl, dequeue_unvisited, reachable, retry_ledger
from spinneret.plans.crawl_index import build_index
from spinneret.sources.tables import fetch
from spinneret.streaming import jobs

START = datetime(2025, 1, 1)
LOG = "url string, ts timestamp, seq bigint, ok boolean"


def _urls(spark, urls):
    return spark.createDataFrame([(u,) for u in urls], "url string")


def _walk(edges, seeds):
    hops, frontier, hop = dict.fromkeys(seeds, 0), set(seeds), 0
    while frontier:
        hop += 1
        frontier = {d for s, d in edges if s in frontier} - set(hops)
        hops |= dict.fromkeys(frontier, hop)
    return hops


@pytest.mark.parametrize("small", [100_000, 5])
def test_reachable_with_cycles_islands_and_a_long_chain(spark, monkeypatch, small):
    monkeypatch.setattr(rounds, "SMALL_TABLE", small)
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "c"), ("x", "y"), ("b", "gone"), ("a", "b")]
    edges += [(f"n{i}", f"n{i + 1}") for i in range(9)] + [("c", "n0"), ("n8", "a")]
    links = spark.createDataFrame(edges, "src_url string, dst_url string")
    found = reachable(links, _urls(spark, ["a"])).collect()
    assert len(found) == len({r.url for r in found})
    assert {r.url: r.hop for r in found} == _walk(edges, ["a"])
    assert {r.url for r in reachable(links, _urls(spark, ["a"]), max_hops=1).collect()} == {"a", "b"}


def test_reachable_with_a_source_that_has_most_links(spark, monkeypatch):
    monkeypatch.setattr(rounds, "SMALL_TABLE", 50)
    rng = random.Random(9)
    edges = [("hub", f"p{i}") for i in range(900)] + [(f"p{rng.randint(0, 1200)}", f"p{rng.randint(0, 1200)}") for _ in range(900)]
    edges += [("p3", "hub"), ("s", "p3")]
    links = spark.createDataFrame(edges, "src_url string, dst_url string")
    assert {r.url: r.hop for r in reachable(links, _urls(spark, ["s"])).collect()} == _walk(edges, ["s"])


def test_crawl_outcome_and_fetch(spark, site):
    seeds = _urls(spark, ["http://localhost:8080/page1.html", "mailto:x@y.z"])
    states = {r.url[-10:]: (r.state, r.hop) for r in crawl(site, seeds).collect()}
    assert states == {
        "page1.html": ("fetched", 0), "page2.html": ("fetched", 1), "page3.html": ("fetched", 2), "ilto:x@y.z": ("given_up", 0),
    }
    fetched = {r.url[-10:]: r.fetched for r in fetch(seeds, site).collect()}
    assert fetched == {"page1.html": True, "ilto:x@y.z": False}


def _crawl_by_hand(links, seeds, outcomes, retries):
    """A queue in rounds, as a crawler keeps it."""
    seen, due, found, hop = {}, [(u, 1) for u in dict.fromkeys(seeds)], {}, 0
    seen = {u: 0 for u, _ in due}
    while due:
        hop += 1
        later, new = [], []
        for url, attempt in due:
            log = outcomes.get(url, "")
            ok = url in links and (log[attempt - 1] == "+" if attempt <= len(log) else True)
            if ok:
                found[url] = (seen[url], attempt, "fetched")
                new += links[url]
            elif attempt > retries:
                found[url] = (seen[url], attempt, "given_up")
            else:
                later.append((url, attempt + 1))
        fresh = [u for u in dict.fromkeys(new) if u not in seen]
        seen |= dict.fromkeys(fresh, hop)
        due = later + [(u, 1) for u in fresh]
    return found


@pytest.mark.parametrize("seed,n", [(2, 120), (3, 200)])
def test_crawl_with_retries(spark, monkeypatch, seed, n):
    """Several hops; pages that answer at attempt 1 to 4, give up after 4, or are no pages; several blocks of ids."""
    monkeypatch.setattr(rounds, "SMALL_TABLE", 100_000 if seed < 3 else 20)
    rng = random.Random(seed)
    urls = [f"http://s.com/{i}" for i in range(n)]
    links = {u: [rng.choice(urls + ["http://out.com/x", "http://out.com/y"]) for _ in range(rng.randint(0, 4))] for u in urls}
    links[urls[0]] = urls[1:5]
    outcomes = {u: "-" * rng.randint(0, 5) + "+" * rng.randint(0, 2) for u in urls if rng.random() < 0.6}
    outcomes |= {urls[0]: "--+", "http://out.com/x": "+"}
    pages = [(i, u, "<body>" + "".join(f'<a href="{v}">x</a>' for v in links[u] * 2)) for i, u in enumerate(urls)]
    pages.append((n, urls[1], f'<a href="{urls[2]}">a second snapshot</a>'))
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    log = spark.createDataFrame(_log(outcomes), LOG)
    seeds = [urls[0], "http://nowhere.com/", urls[0]]
    got = {r.url: (r.hop, r.attempts, r.state) for r in crawl(frame, _urls(spark, seeds), log=log).collect()}
    want = _crawl_by_hand(links, seeds, outcomes, RETRIES)
    assert got == want and len(want) > 3
    assert {a for _, a, s in want.values() if s == "fetched"} >= {1, 2, 3}


def test_a_crawl_that_ends_early(spark):
    urls = [f"http://s.com/{i}" for i in range(4)]
    pages = [(i, u, f'<a href="{v}">x</a>') for i, (u, v) in enumerate(zip(urls, urls[1:] + ["http://out.com/"]))]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    log = spark.createDataFrame(_log({urls[1]: "--+"}), LOG)
    got = {r.url[-1]: (r.hop, r.attempts, r.state) for r in crawl(frame, _urls(spark, urls[:1]), max_hops=2, log=log).collect()}
    assert got == {"0": (0, 1, "fetched"), "1": (1, 2, "pending")}
    none = crawl(frame, _urls(spark, []), log=log)
    assert none.count() == 0
    empty = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert [tuple(r) for r in crawl(empty, _urls(spark, ["u"])).collect()] == [("u", 0, 4, "given_up")]


def test_ids_of_many_masks(spark, monkeypatch):
    """A chain that jumps from mask to mask, and back; bit 63 is the sign."""
    ids = [k * 40_000 for k in range(6)] + [7, 63, 64, 127, 128, 1 << 40]
    edges = spark.createDataFrame(list(zip(ids, ids[1:])) + [(ids[-1], 0)], "src bigint, dst bigint")
    seen = rounds.walk(edges, spark.createDataFrame([(0,)], "id bigint")).collect()
    assert sorted((r.hop, r.id, r.attempts, r.state) for r in seen) == [(k, i, 1, "fetched") for k, i in enumerate(ids)]


def test_dequeue(spark):
    left = dequeue_unvisited(_urls(spark, ["a", "b", "b", "c"]), _urls(spark, ["c"]))
    assert sorted(r.url for r in left.collect()) == ["a", "b"]


def _log(outcomes):
    return [(u, START + timedelta(seconds=i), i, o == "+") for u, text in outcomes.items() for i, o in enumerate(text)]


def _brute(outcomes):
    fates = {}
    for url, text in outcomes.items():
        failures, state, closed = 0, "pending", None
        for i, o in enumerate(text):
            if o == "+":
                state, closed = "fetched", i
                break
            failures += 1
            if failures > RETRIES:
                state, closed = "given_up", i
                break
        fates[url] = (failures, state, closed)
    return fates


OUTCOMES = {"three": "---+", "four": "----+", "first": "+-----", "none": "---", "one": "-", "mixed": "-+-+", "late": "------++"}


def _fates(ledger):
    return {r.url: (r.failures, r.state, r.closed_seq) for r in ledger.collect()}


def test_retry_boundaries(spark):
    assert _fates(retry_ledger(spark.createDataFrame(_log(OUTCOMES), LOG))) == _brute(OUTCOMES)


def test_retries_with_a_hot_url(spark):
    rng = random.Random(8)
    outcomes = OUTCOMES | {"hot": "---" + "+" * 5000} | {
        f"u{i}": "".join(rng.choices("+-", weights=[1, 3], k=rng.randint(1, 9))) for i in range(200)
    }
    rows = _log(outcomes)
    rng.shuffle(rows)
    assert _fates(retry_ledger(spark.createDataFrame(rows, LOG))) == _brute(outcomes)


def test_retry_stream_equals_batch_whatever_the_order(spark, tmp_path):
    rows = _log(OUTCOMES)
    random.Random(7).shuffle(rows)
    spark.createDataFrame(rows, LOG).repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    jobs.retry_stream(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert _fates(jobs.read_retry_ledger(spark, str(tmp_path / "out"))) == _brute(OUTCOMES)


def _folder_rows(spark, folder):
    return {p.name: sorted(r.url for r in spark.read.parquet(str(p)).collect()) for p in sorted(folder.glob("batch=*"))}


def test_retry_stream_leaves_closed_urls_alone(spark, tmp_path):
    """A batch writes the fates that it changes; late attempts of closed URLs change nothing, earlier ones do."""
    batches = [
        {"done": [(1, "-"), (2, "+")], "gone": [(i, "-") for i in range(1, 5)], "open": [(1, "-")]},
        {"open": [(2, "-")], "done": [(9, "-"), (10, "+")], "gone": [(7, "+"), (8, "-")]},
        {"open": [(3, "+")], "new": [(1, "+")], "done": [(0, "-")]},
    ]
    for batch in batches:
        rows = [(u, START + timedelta(seconds=i), i, o == "+") for u, told in batch.items() for i, o in told]
        spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    jobs.retry_stream(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert _folder_rows(spark, tmp_path / "out") == {"batch=0": ["done", "gone", "open"], "batch=1": ["open"], "batch=2": ["done", "new", "open"]}
    fates = _fates(jobs.read_retry_ledger(spark, str(tmp_path / "out")))
    assert fates == {"done": (2, "fetched", 2), "gone": (4, "given_up", 4), "open": (2, "fetched", 3), "new": (0, "fetched", 1)}


def test_index_stream_equals_batch(spark, site, tmp_path):
    source = str(tmp_path / "in")
    again = site.selectExpr("page_id + 10 AS page_id", "url", "html")
    for part in (site.where("page_id < 2"), site.where("page_id = 2").union(again)):
        part.coalesce(1).write.mode("append").parquet(source)
    out = str(tmp_path / "out")
    jobs.index_stream(jobs.page_stream(spark, source), out, str(tmp_path / "state")).awaitTermination()
    docs, rows = jobs.read_stream_index(spark, out)
    assert sorted(r.doc_id for r in docs.collect()) == [0, 1, 2]
    batch_docs, batch_rows = build_index(site)
    expected = sorted((r.token, r.url) for r in batch_rows.join(batch_docs, "doc_id").collect())
    assert sorted((r.token, r.url) for r in rows.join(docs, "doc_id").collect()) == expected


def test_visited_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    for urls in (["a", "b", "a"], ["b", "c"]):
        _urls(spark, urls).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("url string").option("maxFilesPerTrigger", 1).parquet(source)
    query = jobs.first_sightings(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r.url for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b", "c"]


def test_visited_stream_with_an_event_time_bound(spark, tmp_path):
    rows = [("a", START), ("a", START + timedelta(minutes=1)), ("b", START + timedelta(minutes=2))]
    spark.createDataFrame(rows, "url string, at timestamp").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("url string, at timestamp").parquet(str(tmp_path / "in"))
    seen = jobs.first_sightings(stream, "at", "10 minutes").select("url")
    query = seen.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r.url for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]


def test_index_stream_batch_run_again(spark, site, tmp_path):
    """A repeated batch gives the same ids and replaces its own output."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    site.coalesce(1).write.parquet(source)
    for state in ("state1", "state2"):
        jobs.index_stream(jobs.page_stream(spark, source), out, str(tmp_path / state)).awaitTermination()
    docs, rows = jobs.read_stream_index(spark, out)
    assert docs.count() == 3 and rows.count() == 32


def test_index_stream_reads_no_earlier_documents(spark, site, tmp_path):
    """Ids go on from one number; the document rows of earlier batches may be gone."""
    source, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    site.where("page_id < 2").coalesce(1).write.parquet(source)
    jobs.index_stream(jobs.page_stream(spark, source), out, state).awaitTermination()
    (tmp_path / "out" / "doc_table").rename(tmp_path / "moved")
    site.coalesce(1).write.mode("append").parquet(source)
    jobs.index_stream(jobs.page_stream(spark, source), out, state).awaitTermination()
    docs, rows = jobs.read_stream_index(spark, out)
    assert [(r.doc_id, r.url[-10:]) for r in docs.collect()] == [(2, "page3.html")]
    assert sorted({r.doc_id for r in rows.collect()}) == [0, 1, 2]

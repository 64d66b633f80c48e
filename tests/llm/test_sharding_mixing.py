import itertools
import math
import random
from collections import Counter
from statistics import NormalDist

import pytest

from spinneret.llm import mixing, sharding


def test_shards_are_exact_and_gapless(spark):
    rows = spark.range(0, 1003, 1, 7)
    got = sharding.deal(rows, 5, seed=3).collect()
    assert sorted(r["id"] for r in got) == list(range(1003))
    for shard, size in enumerate(sharding.shard_sizes(1003, 5)):
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(size))


def test_many_partitions_use_several_levels(spark):
    counts = spark.range(0, 200).selectExpr("id as node", "id % 7 as n")
    matrix = {r["node"]: r["cols"] for r in sharding.communication_matrix(counts, 4, seed=1).collect()}
    sizes = {r["node"]: r["n"] for r in counts.collect()}
    assert all(sum(matrix[k]) == n for k, n in sizes.items())
    total = sum(sizes.values())
    assert [sum(m[j] for m in matrix.values()) for j in range(4)] == sharding.shard_sizes(total, 4)


@pytest.mark.parametrize("good,bad,draws", [(5, 7, 6), (40, 3, 20), (1000, 3000, 400), (1, 500, 20)])
def test_hypergeometric_inverts_its_distribution(spark, good, bad, draws):
    n = 4000
    expr = sharding.hypergeometric(f"{good}L", f"{bad}L", f"{draws}L", f"(id + 0.5D) / {n}D")
    got = Counter(r[0] for r in spark.range(n).selectExpr(f"{expr} as x").collect())
    cumulative = 0.0
    for k in range(max(0, draws - bad), min(draws, good) + 1):
        p = math.comb(good, k) * math.comb(bad, draws - k) / math.comb(good + bad, draws)
        assert abs(got.get(k, 0) - (math.floor((cumulative + p) * n + 0.5) - math.floor(cumulative * n + 0.5))) <= 1
        cumulative += p
    assert sum(got.values()) == n


@pytest.mark.parametrize("good,bad,draws", [(10**11, 15 * 10**11, 10**10), (25 * 10**6, 15 * 25 * 10**6, 4 * 10**8 - 10**6), (1, 10**11, 10**10)])
def test_hypergeometric_at_cluster_sizes(spark, good, bad, draws):
    """Against the normal quantiles, far into both tails."""
    total = good + bad
    mean, variance = draws * good / total, draws * good / total * bad / total * (total - draws) / (total - 1)
    shares = [1e-6, 0.001, 0.02, 0.3, 0.5, 0.7, 0.98, 0.999, 0.9999, 0.99995, 0.99999, 1 - 1e-6]
    expr = sharding.hypergeometric(f"{good}L", f"{bad}L", f"{draws}L", "u")
    got = {r["u"]: r["x"] for r in spark.createDataFrame([(u,) for u in shares], "u double").selectExpr("u", f"{expr} AS x").collect()}
    if good == 1:
        assert got == {u: int(u > 1 - draws / total) for u in shares}
        return
    for u in shares:
        want = mean + NormalDist().inv_cdf(u) * variance**0.5
        assert abs(got[u] - want) < max(2, 0.02 * variance**0.5)


def test_each_row_reaches_each_shard_about_equally(spark):
    hits = Counter()
    for seed in range(12):
        hits.update((r["id"] % 10, r["shard"]) for r in sharding.deal(spark.range(0, 400, 1, 4), 4, seed).collect())
    assert all(80 < hits[a, b] < 160 for a in range(10) for b in range(4))


def test_sharding_edges(edge_docs, no_docs):
    got = sharding.shard_digest(edge_docs).collect()
    assert len(got) == edge_docs.count() and {r["law"] for r in got} == {"rows"}
    assert {(r["size"], r["text_crc32"]) for r in got if r["doc_id"] in (1, 2)} == {(1, 0)}
    assert sharding.shard_digest(no_docs).count() == 0
    table = sharding.shard_table(edge_docs, 3)
    assert table.columns.count("shard") == 1 and "_row" in table.columns
    assert sorted(r["_row"] for r in table.collect()) == [7] * 15
    assert sorted(map(str, table.select("doc_id", "text").collect())) == sorted(map(str, edge_docs.select("doc_id", "text").collect()))
    assert sharding.shard_table(no_docs).count() == 0


def brute_targets(sizes, weights, share, most):
    target = {s: 0.0 for s in sizes}
    left = share * sum(sizes.values())
    open_sources = [s for s in sizes if sizes[s]]
    while left > 1e-9 and open_sources:
        total = sum(weights[s] for s in open_sources)
        spare = 0.0
        for s in open_sources:
            target[s] += left * weights[s] / total
        for s in list(open_sources):
            if target[s] >= most * sizes[s]:
                spare += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                open_sources.remove(s)
        left = spare
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_repeated_resharing(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i:02d}": rng.choice([0, 1, 5, 50, 500, 5000]) for i in range(9)}
    weights = dict(zip(sorted(sizes), itertools.cycle(mixing.WEIGHTS)))
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in mixing.source_targets(frame).collect()}
    want = brute_targets(sizes, weights, mixing.SHARE, mixing.MOST)
    assert got == pytest.approx(want)


def test_mix_takes_its_targets_and_follows_the_schedule(tables):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randrange(1, 9), f"s{i % 3}") for i in range(3000)]
    docs = tables(rows, "doc_id bigint, text string, source string")
    got = mixing.mix_digest(docs).collect()
    for source in range(3):
        own = [r for r in got if r["doc_id"] % 3 == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 8
        assert all(r["taken"] <= 2 * r["size"] for r in own)
    assert sorted(map(tuple, mixing.mix_digest(docs).collect())) == sorted(map(tuple, got))
    copies = mixing.mix_table(docs).collect()
    assert Counter(r["doc_id"] for r in copies) == Counter({r["doc_id"]: r["copies"] for r in got if r["copies"]})
    early = Counter(r["source"] for r in copies if r["position"] < 0.25)
    late = Counter(r["source"] for r in copies if r["position"] > 0.75)
    assert early["s0"] > 1.5 * late["s0"] and late["s2"] > 1.5 * early["s2"]


def test_mixing_edges(edge_docs, no_docs):
    got = mixing.mix_digest(edge_docs).collect()
    assert len(got) == 15 and all(r["taken"] <= 2 * r["size"] for r in got)
    assert {r["size"] for r in got if r["doc_id"] in (1, 2, 5)} == {0}
    assert mixing.mix_digest(no_docs).count() == 0 and mixing.mix_table(no_docs).count() == 0
    table = mixing.mix_table(edge_docs)
    assert table.columns.count("position") == 1 and {r["_row"] for r in table.collect()} == {7}

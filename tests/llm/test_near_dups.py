import random
import re

import numpy as np
import pytest

from spinneret.llm import near_dups
from spinneret.llm.common import components
from spinneret.llm.shingles import minhash_parameters, minhashes, shingle_set, word_hashes


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows, width, percent):
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: (len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)}


def family(rng, n, edits, words=60):
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    for _ in range(n):
        text = list(base)
        for _ in range(rng.randrange(edits + 1)):
            text[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        yield " ".join(text)


def test_words_are_split_and_lowered_as_told():
    text = "Hello  World\tfoo\x1cbar\nÀé x\x0b HELLO Ä"
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    hashed = word_hashes(text)
    low = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words]
    assert [[a == b for b in hashed] for a in hashed] == [[a == b for b in low] for a in low]


def test_estimates_are_unbiased():
    rng, errors = random.Random(1), []
    factors, masks = minhash_parameters(near_dups.VALUES)
    for _ in range(150):
        a, b = family(rng, 2, 20, 200)
        x, y = shingle_set(a, 3), shingle_set(b, 3)
        both = len(np.intersect1d(x, y))
        one, other = minhashes([x, y], factors, masks)
        errors.append((one == other).mean() - both / (len(x) + len(y) - both))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.06


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_components_equal_all_pairs(tables, width, percent):
    rng = random.Random(width)
    texts = [t for size in (2, 3, 5, 9, 30) for t in family(rng, size, 4)] + list(family(rng, 40, 2)) + ["a b", "A  b", "a b c", "", None]
    texts += [t.upper() for t in texts[:10] if t]
    rng.shuffle(texts)
    rows = [(7 * i - 50, t) for i, t in enumerate(texts)]
    got = near_dups.near_duplicates(tables(rows, "doc_id bigint, text string"), width, percent).collect()
    want = brute(rows, width, percent)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got) and len(got) == len(rows)


def test_no_candidate_of_a_region_is_left_out(tables, monkeypatch):
    """Each text has many neighbours just below the threshold; the few true links lie behind them."""
    monkeypatch.setattr(near_dups, "NEAR", 1)
    monkeypatch.setattr(near_dups, "WIDER", 2)
    rounds, asked = [], near_dups.candidates
    monkeypatch.setattr(near_dups, "candidates", lambda *a, **k: rounds.append(a[3]) or asked(*a, **k))
    rng = random.Random(9)
    rows = list(enumerate(t for _ in range(3) for t in family(rng, 50, 8, 200)))
    got = near_dups.near_duplicates(tables(rows, "doc_id bigint, text string"), 3, 85).collect()
    want = brute(rows, 3, 85)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert len({c for _, c in want.values()}) > 6 and rounds[:3] == [1, 2, 4] and len(rounds) > 4


def test_fine_estimates_are_unbiased():
    rng, errors = random.Random(2), []
    factors, masks = minhash_parameters(near_dups.FINE, seed=2)
    for _ in range(60):
        a, b = family(rng, 2, 20, 200)
        x, y = shingle_set(a, 3), shingle_set(b, 3)
        both = len(np.intersect1d(x, y))
        bits = np.packbits(np.bitwise_count(minhashes([x, y], factors, masks)) & 1, axis=1).view(np.uint64)
        errors.append(near_dups.likeness(bits[0], bits[1]) - both / (len(x) + len(y) - both))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.02


def test_crowded_regions_go_deeper(tables, monkeypatch):
    monkeypatch.setattr(near_dups, "REGION", 12)
    rng = random.Random(4)
    rows = list(enumerate(list(family(rng, 60, 1, 120)) + list(family(rng, 3, 3))))
    got = near_dups.near_duplicates(tables(rows, "doc_id bigint, text string"), 3, 85).collect()
    want = brute(rows, 3, 85)
    assert sum(r["component_id"] == want[r["doc_id"]][1] for r in got) >= 0.95 * len(rows)


def test_texts_that_leave_a_crowd_are_linked(tables, monkeypatch):
    """Distinct copies of one text, each with one edit of its own, and borderline ones beside them."""
    monkeypatch.setattr(near_dups, "REGION", 12)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base[:at] + [f"e{rng.randrange(10**9)}"] + base[at + 1 :]) for at in range(60) for _ in range(4)]
    texts += [" ".join(f"x{n}" if at in (9, 40) else w for at, w in enumerate(base)) for n in range(30)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    got = near_dups.near_duplicates(tables(rows, "doc_id bigint, text string"), 3, 85).collect()
    want = brute(rows, 3, 85)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


def test_thousands_of_distinct_one_edit_copies_are_one_component(tables):
    base = [f"w{i}" for i in range(100)]
    rows = [(n, " ".join(base[: n % 100] + [f"e{n}"] + base[n % 100 + 1 :])) for n in range(3_000)]
    got = near_dups.near_duplicates(tables(rows, "doc_id bigint, text string"), 3, 85).collect()
    assert len(got) == 3_000 and {r["component_id"] for r in got} == {0}


def test_near_dups_edges(edge_docs, no_docs):
    got = near_dups.near_duplicates(edge_docs, 3, 85).collect()
    assert len(got) == 15 and near_dups.near_duplicates(no_docs).count() == 0
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by_id[4]["component_id"] == 3 and by_id[8]["component_id"] == 6 and by_id[1]["component_id"] == 1 and by_id[2]["n_shingles"] == 0
    assert by_id[11]["component_id"] == 6 and by_id[13]["component_id"] == 12 and by_id[12]["n_shingles"] == 1
    assert sorted(str(r["component_id"]) for r in got if r["doc_id"] is None) == ["6", "None"]
    kept = near_dups.without_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["-3", "1", "12", "2", "3", "5", "6", "None"])


@pytest.mark.parametrize("seed", range(3))
def test_star_contraction_equals_union_find(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 360)] + [(400, i) for i in range(401, 450)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_rounds_have_no_more_tasks_than_links_need(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        found = components(spark.createDataFrame([(i, i + 1) for i in range(0, 300, 3)], "a bigint, b bigint").repartition(40))
        assert found.rdd.getNumPartitions() <= 4
        assert {(r["id"], r["component"]) for r in found.collect()} == {(i + j, i) for i in range(0, 300, 3) for j in (0, 1)}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from spinneret.llm import fill_middle, importance, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- operator 11
def brute_fill(doc_id, text, unit="line"):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, _, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    x, y = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, m, z = "".join(units[:x]), "".join(units[x:y]), "".join(units[y:])
    if h4 % 100 < 50:
        return n, "spm", len(a), len(m), f"<S>{z}<P>{a}<M>{m}"
    return n, "psm", len(a), len(m), f"<P>{a}<S>{z}<M>{m}"


def fill_rows():
    rng = random.Random(11)
    parts = ["\n", "\n\n", "line one\n", "é\U0001f600 ü", "<P", "<", "S>", "<M", ">", "<S>", "tail", "\r\n", "\x00", " "]
    return [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(0, 9)))) for i in range(400)]


@pytest.mark.parametrize("unit", ["line", "char"])
def test_fill_equals_strings(tables, unit):
    rows = fill_rows()
    made = fill_middle.fill_in_middle(tables(rows, "doc_id bigint, text string"), unit=unit)
    made = made.withColumn("again", fill_middle.restored("fim.output", "fim.form")).collect()
    assert len(made) == len(rows) and {r["fim"]["form"] for r in made} == {"plain", "psm", "spm"}
    for r in made:
        assert tuple(r["fim"]) == brute_fill(r["doc_id"], r["text"], unit) and r["again"] == r["text"]


def test_fill_digest_and_edges(edge_docs, no_docs):
    texts = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    want = []
    for doc_id, text in texts:
        n, form, prefix, middle, output = brute_fill(doc_id, text)
        sums = [hashlib.sha256(s.encode()).hexdigest() for s in (output, text or "")]
        want.append((doc_id, n, form, prefix, middle, *sums))
    got = [tuple(r) for r in fill_middle.fill_digest(edge_docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert fill_middle.fill_digest(no_docs).count() == 0
    assert fill_middle.fill_in_middle(edge_docs, out="n_chars").columns == [*(c for c in edge_docs.columns if c != "n_chars")][:4] + ["n_chars"] + edge_docs.columns[5:]


def test_fill_rates(tables):
    rows = [(i, "one\ntwo\nthree") for i in range(600)]
    docs = tables(rows, "doc_id bigint, text string")
    forms = [r["fim"]["form"] for r in fill_middle.fill_in_middle(docs, rate=30, spm_rate=100).collect()]
    assert set(forms) == {"plain", "spm"} and 120 < forms.count("spm") < 240
    with pytest.raises(ValueError):
        fill_middle.fill_in_middle(docs, unit="word")


def test_rotation_is_exact_for_all_cuts():
    raw = b"abcdefg"
    for start in range(8):
        for middle in range(start, 8):
            for end in range(middle, 8):
                buffer = bytearray(raw)
                fill_middle.rotate(buffer, start, middle, end)
                assert bytes(buffer) == raw[:start] + raw[middle:end] + raw[start:middle] + raw[end:]


# --- operator 12
def brute_fingerprint(text, width=3):
    words = WORD.findall(ascii_lower(text))
    if not words:
        return 0
    width = min(width, len(words))
    hashes = [xxhash.xxh64(" ".join(words[i : i + width]).encode(), seed=42).intdigest() for i in range(len(words) - width + 1)]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_components(marks, distance):
    """The least fingerprint that each one reaches, over all pairs."""
    marks = sorted(set(marks))
    parent = {m: m for m in marks}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(marks):
        for y in marks[:i]:
            if (x ^ y).bit_count() <= distance:
                low, high = sorted((root(x), root(y)))
                parent[high] = low
    return {m: root(m) for m in marks}


def test_fingerprints_are_the_jvm_hash(spark, edge_docs):
    got = spark.sql("SELECT xxhash64('ab cd é') AS h").first()["h"]
    assert got % 2**64 == xxhash.xxh64("ab cd é".encode(), seed=42).intdigest()
    for r in edge_docs.collect():
        assert simhash.fingerprint(r["text"], 3) == brute_fingerprint(r["text"])
    long = "one two " * 40_000 + "three"
    assert simhash.fingerprint(long, 3) == brute_fingerprint(long)


def test_every_close_pair_has_a_head_in_common():
    """Each distance's keys, and what any refinement of them adds, hold every pair within it."""
    rng = random.Random(5)
    for distance in (1, 2, 3):
        masks = simhash.head_masks(distance)
        for _ in range(1500):
            flips = rng.sample(range(64), rng.randint(1, distance))
            differ = sum(1 << b for b in flips)
            met = [m for _, m in masks if not differ & m]
            assert met
            for mask in met[:2]:
                while (finer := simhash.finer_masks(mask, distance)):
                    mask = next(m for m in finer if not differ & m)
                    if mask.bit_count() > 56:
                        break
    assert simhash.chain_budgets(3) == [0, 0, 1, 1, 1, 2, 2, 3] and len(simhash.head_masks(3)) == 24


def clustered(rng, n_centres, n_each, flips):
    marks = []
    for _ in range(n_centres):
        centre = rng.getrandbits(64)
        for _ in range(n_each):
            m = centre
            for b in rng.sample(range(64), rng.randint(0, flips)):
                m ^= 1 << b
            marks.append(m)
    return marks


@pytest.mark.parametrize("distance,crowd", [(3, 256), (3, 32), (2, 32), (1, 4)])
def test_links_equal_all_pairs(spark, monkeypatch, distance, crowd):
    """Also where nearly every key is crowded and refined several times."""
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = random.Random(distance * crowd)
    marks = clustered(rng, 6, 120, 4) + [rng.getrandbits(64) for _ in range(300)] + [0, 2**64 - 1]
    marks += [(0xABCD << 48) | rng.getrandbits(10) for _ in range(300)]
    want = brute_components(marks, distance)
    signed = {m - 2**64 if m >> 63 else m: m for m in marks}
    fps = spark.createDataFrame([(s,) for s in signed], "fp bigint")
    found = simhash.components(simhash.links(simhash.shared_keys(fps, distance), distance)).collect()
    got = {signed[r["id"]]: signed[r["component"]] for r in found}
    groups = {}
    for m in want:
        groups.setdefault(want[m], set()).add(m)
    joined = {}
    for m in want:
        joined.setdefault(got.get(m, m), set()).add(m)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, joined.values()))


def test_forest_keeps_components():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 500, 400), rng.integers(0, 500, 400)
    low, high = simhash.forest(a, b)
    parent = {int(x): int(y) for x, y in zip(high, low)}
    for x, y in zip(a.tolist(), b.tolist()):
        assert parent.get(x, x) == parent.get(y, y)
    assert len(low) <= len(set(a.tolist()) | set(b.tolist())) and (low < high).all()


def brute_simhash(rows, width=3, distance=3):
    marks = [brute_fingerprint(t, width) for _, t in rows]
    comps = brute_components(marks, distance)
    least = {}
    for (doc_id, _), m in zip(rows, marks):
        if doc_id is not None:
            least[comps[m]] = min(least.get(comps[m], doc_id), doc_id)
    return sorted(((d, f"{m:016x}", least.get(comps[m])) for (d, _), m in zip(rows, marks)), key=repr)


def test_simhash_equals_brute_force(spark, tables, edge_docs, no_docs):
    rng = random.Random(12)
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    rows = []
    for i in range(60):
        base = [rng.choice(words) for _ in range(rng.choice([2, 5, 60, 300]))]
        for k in range(rng.randrange(1, 6)):
            text = list(base)
            if k and len(text) > 5:
                text[rng.randrange(len(text))] = "OTHER"
            rows.append((1000 - len(rows), " ".join(text)))
    rows += [(None, None), (None, "alpha beta"), (-1, ""), (-2, " \n"), (-2, " \n")]
    got = simhash.near_duplicates(tables(rows, "doc_id bigint, text string"), width=3).collect()
    assert sorted((tuple(r)[:3] for r in got), key=repr) == brute_simhash(rows)
    edges = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    got = simhash.near_duplicates(edge_docs, width=3).collect()
    assert sorted((tuple(r)[:3] for r in got), key=repr) == brute_simhash(edges)
    assert simhash.near_duplicates(no_docs).count() == 0
    with pytest.raises(ValueError):
        simhash.near_duplicates(no_docs, distance=4)


def test_simhash_on_the_smallest_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = simhash.near_duplicates(docs, width=3).collect()
    assert sorted((tuple(r)[:3] for r in got), key=repr) == brute_simhash(rows)


# --- operator 13
def brute_importance(rows, target, buckets=10_000, percent=25, min_words=20):
    def hashed(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text))
        runs = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
        return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]

    def counts(texts):
        n = [0] * buckets
        for text in texts:
            for b in hashed(text)[1]:
                n[b] += 1
        return n

    s, t = counts(x for _, x in rows), counts(target)
    total_s, total_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets)))) for b in range(buckets)]
    made = []
    for doc_id, text in rows:
        n_words, found = hashed(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        made.append((n_words, doc_id, len(found), weight, score))
    asked = sorted((x for x in made if x[0] >= min_words), key=lambda x: (-x[4], x[1] is None, x[1] or 0, x[2], x[3]))
    drawn = percent * len(asked) // 100
    out = [(*x[1:], k + 1 if k < drawn else None) for k, x in enumerate(asked)]
    return sorted(out + [(*x[1:], None) for x in made if x[0] < min_words], key=repr)


def importance_rows():
    rng = random.Random(13)
    words = ["Alpha", "beta", "gamma-delta", "é", "ÀB", "12", "x\x00y", "the", "a_b", "naïve", "~", "Z9"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 60)))) for i in range(200)]
    return rows + [(7, rows[7][1]), (7, "beta " * 30), (None, "alpha " * 25), (None, None), (500, "-- ,,"), (501, "beta " * 2_000_000)]


def test_importance_equals_brute_force(tables, edge_docs, no_docs):
    rows, target = importance_rows(), ["beta gamma 12", None, "the alpha, the beta", ""]
    texts = tables([(t,) for t in target], "text string")
    got = importance.importance_digest(tables(rows, "doc_id bigint, text string"), texts).collect()
    assert sorted(map(tuple, got), key=repr) == brute_importance(rows, target)
    edges = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    got = importance.importance_digest(edge_docs, no_docs).collect()
    assert sorted(map(tuple, got), key=repr) == brute_importance(edges, [])
    assert importance.importance_digest(no_docs, texts).count() == 0


def test_resample_returns_the_drawn_rows(tables, edge_docs, no_docs):
    rows, target = importance_rows()[:200], ["beta gamma 12"]
    docs, texts = tables([(*r, "x") for r in rows], "doc_id bigint, text string, importance string"), tables([(t,) for t in target], "text string")
    drawn = importance.resample(docs, texts)
    want = {r[0] for r in brute_importance(rows, target) if r[-1] is not None}
    assert drawn.columns == docs.columns and sorted(r["doc_id"] for r in drawn.collect()) == sorted(want)
    assert importance.resample(no_docs, texts).count() == 0
    assert importance.resample(edge_docs, texts).columns == edge_docs.columns


def test_importance_on_the_smallest_table(spark):
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = importance.importance_digest(docs, items).collect()
    assert sorted(map(tuple, got), key=repr) == brute_importance(rows, [r["text"] for r in items.collect()])

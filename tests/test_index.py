import random
from datetime import datetime

import pytest

from spinneret.operators import blocks, layout, postings, prefixes, search, segments, terms
from spinneret.operators.documents import (
    build_doc_table, count_documents, extend_doc_table, ids_of_urls, indexed_documents, list_documents, urls_of_ids,
)
from spinneret.operators.ordering import dense_rank, in_ranges, offsets, scan_max
from spinneret.plans import catalog
from spinneret.plans.crawl_index import build_index, crawl_and_index
from spinneret.sources.index_files import TRIE, read_segment, read_segments, write_index, write_segment
from spinneret.sources.tables import seed_urls

NOW = datetime(2025, 6, 23, 10, 30)


def as_index(docs, rows):
    found = {}
    for row in rows.join(docs, "doc_id").collect():
        found.setdefault(row.token, set()).add(int(row.url[-6]))
    return found


def test_site_index(spark, site, site_index):
    seeds = seed_urls(spark, "http://localhost:8080/page1.html")
    docs, rows = crawl_and_index(site, seeds)
    assert rows.count() == 32
    assert as_index(docs, rows) == site_index
    assert indexed_documents(docs, rows).count() == count_documents(docs).first().n_docs == 3
    edges = rows.selectExpr("0 AS block", "token").groupBy("block").agg({"token": "min"}).selectExpr("block", "'' AS first", "'~' AS last")
    found = search.search_words(["Running"], rows.selectExpr("token", "doc_id", "cast(0 AS bigint) AS block"), edges, docs).collect()
    assert [(r.term, r.url[-10:]) for r in found] == [("run", "page3.html")]


def test_doc_ids(spark):
    pages = spark.createDataFrame([(i, f"u{i % 40:02d}", "") for i in range(100)], "page_id bigint, url string, html string")
    docs = build_doc_table(pages)
    rows = [(r.doc_id, r.url) for r in list_documents(docs).collect()]
    assert rows == [(i, f"u{i:02d}") for i in range(40)]
    more = spark.createDataFrame([(200, "u03", ""), (201, "a", ""), (202, "z", "")], "page_id bigint, url string, html string")
    assert sorted((r.doc_id, r.url) for r in extend_doc_table(docs, more, 40).collect()) == [(40, "a"), (41, "z")]
    asked = spark.createDataFrame([("u05",), ("nope",)], "url string")
    assert {r.url: r.doc_id for r in ids_of_urls(docs, asked).collect()} == {"u05": 5, "nope": None}
    ids = spark.createDataFrame([(5,), (-1,), (40,)], "doc_id bigint")
    assert {r.doc_id: r.url for r in urls_of_ids(docs, ids).collect()} == {5: "u05", -1: None, 40: None}


def test_document_without_tokens_has_an_id(spark):
    pages = spark.createDataFrame([(0, "a", "<body>!</body>"), (1, "b", "<body>word</body>")], "page_id bigint, url string, html string")
    docs, rows = build_index(pages)
    assert docs.count() == 2
    assert [(r.token, r.doc_id) for r in rows.collect()] == [("word", 1)]


def test_order_without_a_global_window(spark):
    rng = random.Random(1)
    keys = rng.sample(range(10**6), 3000)
    sizes = {f"{k:07d}": rng.randint(1, 9) for k in keys}
    df = spark.createDataFrame(list(sizes.items()), "key string, size bigint").repartition(7)
    ranks = {r.key: r.rank for r in dense_rank(df, "key", out="rank").collect()}
    assert ranks == {k: i for i, k in enumerate(sorted(sizes))}
    starts = {r.key: r.start for r in offsets(df, "key", size="size", out="start").collect()}
    total, expected = 0, {}
    for key in sorted(sizes):
        expected[key] = total
        total += sizes[key]
    assert starts == expected
    sparse = df.selectExpr("key", "CASE WHEN cast(key AS int) % 50 = 0 THEN cast(key AS int) END AS v")
    seen = {r.key: r.m for r in scan_max(in_ranges(sparse, "key"), "v", out="m").collect()}
    best = None
    for key in sorted(sizes):
        best = int(key) if int(key) % 50 == 0 else best
        assert seen[key] == best


def test_stems_with_a_vocabulary_too_large_to_broadcast(spark):
    rng = random.Random(2)
    words = ["running"] * 500 + ["runs"] * 300 + [f"word{rng.randint(0, 400)}s" for _ in range(800)]
    rows = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "id bigint, token string")
    small = sorted(map(tuple, terms.stem_rows(rows).select("id", "stem").collect()))
    large = sorted(map(tuple, terms.stem_rows(rows, broadcast_words=5).select("id", "stem").collect()))
    assert small == large and len(small) == len(words)


def _brute_layouts(index):
    def width(n):
        return max(1, -(-n.bit_length() // 7))

    fixed, compact, a, b = {}, {}, 0, 0
    for token in sorted(index):
        ids = sorted(index[token])
        fixed[token], compact[token] = a, b
        a += 4 + 4 * len(ids)
        b += width(len(ids)) + sum(width(x - y) for x, y in zip(ids, [0] + ids))
    return fixed, compact


def test_layouts(spark):
    rng = random.Random(3)
    index = {"edge": {0, 127, 128, 16383, 16384, 65535, 65536, 70000, 200000}, "hot": set(range(0, 140000, 7))}
    index |= {f"t{i}": set(rng.sample(range(300000), rng.randint(1, 30))) for i in range(50)}
    rows = spark.createDataFrame([(t, d) for t, ids in index.items() for d in ids], "token string, doc_id bigint")
    fixed, compact = _brute_layouts(index)
    assert {r.token: r.offset for r in layout.fixed_layout(rows).collect()} == fixed
    assert {r.token: r.offset for r in layout.compact_layout(rows).collect()} == compact
    arrays = postings.posting_blocks(rows).collect()
    assert max(len(r.doc_ids) for r in arrays) <= postings.BLOCK
    assert sum(r.n_docs for r in arrays) == sum(map(len, index.values()))


def test_fixed_dictionary_leaves_out_long_tokens(spark):
    entries = [("a" * 64, 1), ("a" * 65, 2), ("b", 3)]
    token_dict = spark.createDataFrame(entries, "token string, offset bigint")
    kept = layout.fixed_dictionary(token_dict).orderBy("slot").collect()
    assert [(r.slot, len(r.token), r.record_at) for r in kept] == [(0, 64, 0), (1, 1, 72)]
    assert [r.token_bytes for r in layout.too_long_tokens(token_dict).collect()] == [65]


def _dictionary(spark, words):
    return spark.createDataFrame(list(words.items()), "token string, offset bigint")


def test_trie(spark):
    words = dict(apple=10, app=20, bat=11, batman=15, append=40, apprehend=100, appendix=21)
    nodes = {r.prefix: r for r in prefixes.trie(_dictionary(spark, words)).collect()}
    assert (nodes[""].val, nodes[""].is_terminal, nodes[""].n_children, nodes[""].offset) == ("-", False, 2, -1)
    assert {p: n.offset for p, n in nodes.items() if n.is_terminal} == words
    assert {p for p, n in nodes.items() if n.is_terminal and n.n_children} == {"app", "append", "bat"}
    assert set(nodes) == {w[:i] for w in words for i in range(len(w) + 1)}
    single = prefixes.trie(_dictionary(spark, {"only": 1})).collect()
    assert [(r.prefix, r.offset) for r in single if r.is_terminal] == [("only", 1)]
    empty = prefixes.trie(spark.createDataFrame([], "token string, offset bigint")).collect()
    assert [tuple(r) for r in empty] == [("", 0, "-", True, -1, 0)]


def _some_words(seed):
    """Words with long shared prefixes and endings, in alphabets small and not ASCII."""
    rng = random.Random(seed)
    parts = ["a", "b", "ab", "ing", "ed", "é", "\U0001f600", "aaaaaaa", "9"]
    return {"".join(rng.choice(parts) for _ in range(rng.randint(1, 6))): i for i in range(rng.choice([3, 60, 400]))}


@pytest.mark.parametrize("seed", range(3))
def test_trie_over_many_ranges(spark, seed):
    """Ranges of a few tokens, whose first nodes hang on paths from several ranges before."""
    words = _some_words(seed)
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        nodes, tokens = prefixes.trie_nodes(_dictionary(spark, words))
        rows, ranked = nodes.collect(), {r.slot: r.token for r in tokens.collect()}
        edges = prefixes.automaton(_dictionary(spark, words)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    spelled = {ranked[r.slot][: r.depth]: r for r in rows}
    heads = {w[:i] for w in words for i in range(len(w) + 1)}
    assert len(rows) == len(spelled) and set(spelled) == heads and [ranked[i] for i in range(len(words))] == sorted(words)
    for head, r in spelled.items():
        assert r.n_children == len({h for h in heads if len(h) == len(head) + 1 and h.startswith(head)})
        assert (r.is_terminal, r.offset) == (head in words, words.get(head, -1))
        assert r.slot == min(i for i, t in ranked.items() if t.startswith(head))
        if head:
            assert r.val == head[-1] and ranked[r.parent][: r.depth - 1] == head[:-1] and r.parent == spelled[head[:-1]].slot
    # States are the distinct sets of endings; walking the transitions spells the words and no others.
    languages = {frozenset(w[len(h) :] for w in words if w.startswith(h)) for h in heads}
    states = {(r.state_slot, r.state_depth) for r in edges} | {(r.target_slot, r.target_depth) for r in edges}
    assert len(states) == len(languages) <= len(heads)
    out = {}
    for r in edges:
        assert (r.letter not in out.setdefault((r.state_slot, r.state_depth), {}))
        out[r.state_slot, r.state_depth][r.letter] = (r.target_slot, r.target_depth, r.final)
    found, todo = set(), [((0, 0), "")]
    while todo:
        state, text = todo.pop()
        for letter, (slot, depth, final) in out.get(state, {}).items():
            found |= {text + letter} if final else set()
            todo.append(((slot, depth), text + letter))
    assert found == set(words)


def test_trie_of_a_very_long_token_is_written_in_linear_space(spark, tmp_path):
    words = {"ab" * 50_000: 1, "ab" * 50_000 + "c": 2, "ab" * 20_000 + "x": 3, "b": 4}
    nodes, _ = prefixes.trie_nodes(_dictionary(spark, words))
    nodes.select(*TRIE).write.parquet(str(tmp_path / "trie"))
    written = spark.read.parquet(str(tmp_path / "trie"))
    assert written.count() == 100_000 + 1 + 1 + 1 + 1 and written.where("is_terminal").count() == 4
    assert sum(f.stat().st_size for f in (tmp_path / "trie").glob("*.parquet")) < 40 * 100_000


@pytest.mark.parametrize("compact", [True, False])
def test_segment_round_trip(spark, site, site_index, tmp_path, compact):
    docs, rows = build_index(site)
    tables = read_segment(spark, write_segment(rows, docs, str(tmp_path), "s1", compact, NOW), "s1")
    assert as_index(tables["doc_table"], tables["postings"]) == site_index
    assert [r.token for r in tables["token_dict_fixed"].orderBy("slot").collect()] == sorted(site_index)
    meta = tables["segment_meta"].first()
    assert tuple(meta) == ("s1", 24, 3, "and", "word", "2025-06-23T10:30:00Z")
    assert [(r.block, r.token, r.n_tokens) for r in tables["token_samples"].collect()] == [(0, "and", 24)]


def test_index_dumps(spark, site, site_index, tmp_path):
    _, rows = build_index(site)
    path = write_index(rows, str(tmp_path / "dump"), "txt", NOW)
    assert path.endswith("dump_20250623_103000.txt")
    lines = [line for f in sorted((tmp_path / "dump_20250623_103000.txt").glob("part-*")) for line in f.read_text().splitlines()]
    assert len(lines) == 24 + 32
    heads = [line for line in lines if line.startswith("Token: ")]
    assert heads == [f"Token: Token[key={t}]" for t in sorted(site_index)]
    at = lines.index("Token: Token[key=go]")
    assert lines[at + 1 : at + 3] == ["------DocId: 0-----", "------DocId: 1-----"]
    table = spark.read.parquet(write_index(rows, str(tmp_path / "dump"), "parquet", NOW))
    assert {r.token: len(r.doc_ids) for r in table.collect()} == {t: len(p) for t, p in site_index.items()}
    with pytest.raises(ValueError):
        write_index(rows, str(tmp_path / "dump"), "xml", NOW)


def _files_read(df):
    """Files that each scan of a frame has read, by the metric of the scan, once the frame has run."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        plan = todo.pop()
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(plan.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(plan.plan())
        if name == "FileSourceScanExec":
            found.append((plan.metrics().apply("numFiles").value(), plan.relation().location().inputFiles()))
        children = plan.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def _opened(df, folder):
    """``(files read, files there)`` of the scan of one table; none where an empty join made the scan needless."""
    found = [(n, len(files)) for n, files in _files_read(df) if files and f"/{folder}/" in files[0]]
    return found[0] if found else (0, None)


def test_a_look_up_reads_the_blocks_of_its_terms(spark, tmp_path):
    rng = random.Random(3)
    tokens = [f"t{i:04d}" for i in range(2000)]
    rows = [(t, d) for t in tokens for d in range(rng.randint(1, 4))] + [("t1000", d) for d in range(4, 3000)]
    docs = spark.createDataFrame([(i, f"u{i}") for i in range(3000)], "doc_id bigint, url string")
    postings_ = spark.createDataFrame(rows, "token string, doc_id bigint")
    written = read_segment(spark, write_segment(postings_, docs, str(tmp_path), "s", True, NOW, block_rows=300), "s")
    n_blocks = written["posting_edges"].count()
    assert n_blocks > 20 and written["token_edges"].count() > 5
    for asked in (["t0007"], ["t1000"], ["", "t1000x", "zz"], tokens[::2] + ["none"]):
        terms_ = spark.createDataFrame([(t,) for t in asked], "term string")
        found = search.search(terms_, written["postings"], written["posting_edges"], written["doc_table"])
        assert sorted((r.term, r.url) for r in found.collect()) == sorted((t, f"u{d}") for t, d in rows if t in asked)
        entries = search.look_up(terms_, written["token_dict"], written["token_edges"])
        assert sorted(r.token for r in entries.collect()) == sorted(t for t in asked if t in tokens)
        n_posting_files, there = _opened(found, "postings")
        n_dict_files, _ = _opened(entries, "token_dict")
        assert there in (n_blocks, None)
        if asked == ["t0007"]:
            assert n_posting_files <= 2 and n_dict_files == 1
        if asked == ["t1000"]:
            assert 8 < n_posting_files < 14 and n_dict_files == 1
        if len(asked) > 3:
            assert n_posting_files == n_blocks


def test_more_places_than_are_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(blocks, "BROADCAST_TERMS", 3)
    rows = spark.createDataFrame([(f"w{i:03d}", i % 5) for i in range(400)], "token string, doc_id bigint")
    docs = spark.createDataFrame([(i, f"u{i}") for i in range(5)], "doc_id bigint, url string")
    written = read_segment(spark, write_segment(rows, docs, str(tmp_path), "s", True, NOW, block_rows=40), "s")
    terms_ = spark.createDataFrame([(f"w{i:03d}",) for i in range(100, 120)], "term string")
    found = search.look_up(terms_, written["token_dict"], written["token_edges"])
    assert sorted(r.token for r in found.collect()) == [f"w{i:03d}" for i in range(100, 120)]
    n_files, there = _opened(found, "token_dict")
    assert n_files <= 2 < there


def test_tokens_with_equal_heads(spark, tmp_path):
    """Blocks are told apart by the heads of their tokens; longer common prefixes only add blocks."""
    long = [("x" * 100 + f"{i:03d}", i) for i in range(200)]
    docs = spark.createDataFrame([(i, f"u{i}") for i in range(200)], "doc_id bigint, url string")
    written = read_segment(spark, write_segment(spark.createDataFrame(long, "token string, doc_id bigint"), docs, str(tmp_path), "s", False, NOW, block_rows=30), "s")
    terms_ = spark.createDataFrame([("x" * 100 + "007",), ("x" * 64,), ("x" * 65,)], "term string")
    found = search.search(terms_, written["postings"], written["posting_edges"], written["doc_table"]).collect()
    assert [(r.term, r.url) for r in found] == [("x" * 100 + "007", "u7")]


def test_search_reads_several_written_segments(spark, tmp_path):
    """Segment ids stay as they are spelled, and a segment that cannot hold a term is not opened."""
    rows, names = [], ["007", "1e3", "7"]
    for segment, name in enumerate(names):
        tokens = [f"w{segment}{i:02d}" for i in range(40 + segment)] + ["w"] * (segment < 2)
        own = spark.createDataFrame([(t, i % 7) for i, t in enumerate(tokens)], "token string, doc_id bigint")
        urls = spark.createDataFrame([(i, f"u{segment}-{i}") for i in range(7)], "doc_id bigint, url string")
        write_segment(own, urls, str(tmp_path), name, True, NOW, block_rows=10)
        rows += [(name, t, f"u{segment}-{i % 7}") for i, t in enumerate(tokens)]
    written = read_segments(spark, str(tmp_path))
    assert {r.segment_id for r in written["postings"].select("segment_id").distinct().collect()} == set(names)
    assert {r.segment_id: r.token_count for r in written["segment_meta"].collect()} == {"007": 41, "1e3": 42, "7": 42}
    for asked in (["w003", "w141", "none"], [t for _, t, _ in rows[::2]], []):
        terms_ = spark.createDataFrame([(t,) for t in asked], "term string").distinct()
        got = segments.search_segments(terms_, written)
        assert {(r.segment_id, r.term, r.url) for r in got.collect()} == {r for r in rows if r[1] in asked}
    # With all other files gone, a term is still found in its own block of its own segment.
    (place,) = written["posting_edges"].where("segment_id = '7' AND first <= 'w205' AND 'w205' <= last").collect()
    for file in (tmp_path / "postings").glob("segment_id=*/block=*/*.parquet"):
        if f"segment_id=7/block={place.block}/" not in str(file):
            file.unlink()
    got = segments.search_segments(spark.createDataFrame([("w205",), ("a",), ("zz",)], "term string"), written)
    assert [(r.segment_id, r.term, r.url) for r in got.collect()] == [("7", "w205", "u2-5")]


def test_round_trip_keeps_tokens_too_long_for_a_record(spark, tmp_path):
    rows = spark.createDataFrame([("x" * 80, 0), ("word", 0)], "token string, doc_id bigint")
    docs = spark.createDataFrame([(0, "u")], "doc_id bigint, url string")
    written = read_segment(spark, write_segment(rows, docs, str(tmp_path), "long", False, NOW), "long")
    assert [r.token for r in written["token_dict_rejects"].collect()] == ["x" * 80]
    assert written["postings"].join(written["token_dict"], "token").count() == 2


def test_merged_segments_are_the_whole_index(spark):
    rng = random.Random(6)
    whole = {(f"t{rng.randint(0, 60)}", f"u{rng.randint(0, 80):02d}") for _ in range(900)}
    doc_rows, posting_rows = [], []
    for segment in range(3):
        part = [p for i, p in enumerate(sorted(whole)) if i % 3 == segment]
        ids = {u: i for i, u in enumerate(sorted({u for _, u in part}, reverse=True))}
        doc_rows += [(segment, i, u) for u, i in ids.items()]
        posting_rows += [(segment, t, ids[u]) for t, u in part]
    docs, rows = segments.merge_segments(
        spark.createDataFrame(doc_rows, "segment_id int, doc_id bigint, url string"),
        spark.createDataFrame(posting_rows, "segment_id int, token string, doc_id bigint"),
    )
    merged = [(r.token, r.url) for r in rows.join(docs, "doc_id").collect()]
    in_order = [(r.token, r.doc_id) for r in rows.collect()]
    assert in_order == sorted(in_order)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(token" not in plan and "rangepartitioning(token" in plan
    assert len(merged) == len(whole) and set(merged) == whole
    assert sorted(r.doc_id for r in docs.collect()) == list(range(docs.count()))


def test_sampled_index_and_prefixes(spark):
    tokens = sorted({f"{c}{i}" for c in "bdf" for i in range(100)})
    token_dict = spark.createDataFrame([(t, i) for i, t in enumerate(tokens)], "token string, offset bigint")
    samples = search.sampled_index(token_dict, 16)
    assert [(r.block, r.token) for r in samples.orderBy("block").collect()] == list(enumerate(tokens[::16]))
    asked = ["a", "b0", "b1x", "c", "d50", "zz"]
    found = search.find_samples(spark.createDataFrame([(t,) for t in asked], "term string"), samples).collect()
    expected = {t: max((i for i, s in enumerate(tokens[::16]) if s <= t), default=None) for t in asked}
    assert {r.term: r.block for r in found} == expected
    heads = spark.createDataFrame([("b1",), ("d",), ("x",), ("b10",)], "prefix string")
    pairs = {(r.prefix, r.token) for r in search.complete(heads, token_dict).collect()}
    assert pairs == {(p, t) for p in ("b1", "d", "x", "b10") for t in tokens if t.startswith(p)}
    assert search.with_prefix(token_dict, "b9").count() == 11
    assert [r.token for r in search.in_range(token_dict, "b98", "d0").orderBy("token").collect()] == ["b98", "b99", "d0"]


def test_seed_list(spark):
    urls = [r.url for r in seed_urls(spark, " http://a , ,http://b,http://a, ").collect()]
    assert sorted(urls) == ["http://a", "http://a", "http://b"]
    for blank in (None, "", "  "):
        with pytest.raises(ValueError):
            seed_urls(spark, blank)


def test_small_blocks_grow_with_the_table():
    assert [blocks.number_of_blocks(n, 1 << 15) for n in (0, 1, 1 << 15, (1 << 15) + 1, 1 << 20)] == [1, 1, 1, 2, 32]
    # Each block is a task, a folder and some samples on the driver: a large table has none of few rows.
    assert blocks.number_of_blocks(10**7, 1 << 15) == blocks.SMALL_BLOCKS
    assert blocks.number_of_blocks(10**9, 1 << 15) == blocks.number_of_blocks(10**9, blocks.BLOCK_ROWS) == 1000
    assert blocks.number_of_blocks(10**7, 4 * blocks.BLOCK_ROWS) == 3


def test_rows_of_all_segments_are_renumbered_once(spark, tmp_path, monkeypatch):
    pages = [(i, f"https://a.example/{i}", f"<html><body>word{i} common</body></html>") for i in range(8)]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    cut, kept = catalog.cut_lineage, []
    monkeypatch.setattr(catalog, "cut_lineage", lambda df: kept.append(df.columns) or cut(df))
    monkeypatch.setattr(catalog, "_published", {})
    written = catalog.written_segments(spark, str(tmp_path))
    # No joined copy of the postings for each segment.
    assert not [columns for columns in kept if "token" in columns]
    rows = written["postings"].join(written["doc_table"], ["segment_id", "doc_id"]).select("segment_id", "token", "url").collect()
    assert sorted(map(tuple, rows)) == sorted((str(i % 4), t, u) for i, u, _ in pages for t in (f"word{i}", "common"))

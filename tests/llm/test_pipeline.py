"""Each stage against what its operator says on the same input; and the registered queries."""

import pytest
from check_oracle import compare, connect

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from spinneret.llm import catalog, decontamination, mixing, near_dups, toxicity
from spinneret.llm.common import packed, with_row

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    out, docs = [], spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, SF_DIR).write.parquet(path)
        out.append((docs, spark.read.parquet(path)))
        docs = out[-1][1]
    return out


def ids(frame):
    return sorted(r["doc_id"] for r in frame.select("doc_id").collect())


def test_stages_filter_as_their_operators_say(spark, staged):
    (docs, clean), (_, single), (_, fair), (_, mixed), (_, sharded) = staged
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    score = toxicity.probability(docs, toxicity.fit(docs, labels, folds=None))
    assert ids(clean) == ids(docs.where(score < 0.5)) and clean.count() < docs.count()
    assert ids(single) == ids(near_dups.near_duplicates(clean).where("kept")) and single.count() < clean.count()
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    assert ids(fair) == ids(decontamination.decontaminate(single, bench).where("not contaminated"))
    plan = mixing.mix_digest(fair).collect()
    assert ids(mixed) == sorted(r["doc_id"] for r in plan for _ in range(r["copies"]))
    assert ids(sharded) == ids(mixed)
    for before, after in staged[:-1]:
        assert after.columns == before.columns == docs.columns
    sizes = [r["count"] for r in sharded.groupBy("shard").count().collect()]
    assert max(sizes) - min(sizes) <= 1 and len(sizes) == 16


def test_stages_take_odd_and_empty_tables(spark, tmp_path, edge_docs, no_docs):
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{SF_DIR}/{table}.parquet").write.parquet(f"{tmp_path}/{table}.parquet")
    for docs in (edge_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, str(tmp_path)).count() >= (docs.count() > 0)


def test_run_returns_what_the_stages_make(spark, staged):
    got = corpus_pipeline.run(spark, SF_DIR)
    assert got.columns == staged[-1][1].columns and ids(got) == ids(staged[-1][1])


@pytest.mark.parametrize("name", list(catalog.all_statements()))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF_DIR), name, queries()[name], oracle_sql()[name], SF_DIR) is None


def test_all_are_registered():
    found = queries()
    assert all(sum(name.startswith(f"op{n}_") for name in found) == 1 for n in range(1, 11)) and "pipeline" in found


def test_row_numbers_do_not_depend_on_splits(spark, tmp_path):
    """Not on the cores, nor on the size of a split."""
    path = str(tmp_path / "t.parquet")
    spark.range(0, 40_000, 1, 5).selectExpr("id AS doc_id", "repeat('word ', 20) AS text").write.option("parquet.block.size", "65536").parquet(path)
    found = []
    for cores, size in ((2, "128m"), (16, "20k")):
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", str(cores))
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            docs = spark.read.parquet(path)
            rows = with_row(docs.select("doc_id", "text"))
            packed_rows = {r["_row"]: r["id"] for r in packed(docs).selectExpr("_row", "doc.doc_id AS id").collect()}
            found.append((docs.rdd.getNumPartitions(), {r["_row"]: r["doc_id"] for r in rows.select("_row", "doc_id").collect()}, packed_rows))
        finally:
            spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found[0][0] != found[1][0] and len(found[0][1]) == 40_000
    assert found[0][1] == found[1][1] == found[0][2] == found[1][2]

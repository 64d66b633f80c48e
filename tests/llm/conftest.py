import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _row int, shard string, slot int, position int, size int, component string, number int, score string, rep int"
EXTRA = (7, "x", 1, 2, 3, "y", 4, "z", 5)
LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 3000
SITE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen"


def edge_rows():
    """Nulls in every column, empty and long texts, copies, repeated rows."""
    rows = [
        (1, "", "en", "a", 0), (2, None, "en", "a", None), (3, LONG, "de", "b", len(LONG)), (4, LONG, None, None, 1),
        (5, "  \n\t ", "fr", None, 5), (6, SITE, "en", "b", 9), (7, SITE.upper(), "en", "b", 9), (8, SITE, "en", "c", 9),
        (8, SITE, "en", "c", 9), (None, SITE, "en", "c", 9), (None, None, None, None, None), (-3, "é ü \U0001f600 ​", "es", "ä", 4),
        (11, SITE + " nineteen", "en", "c", 3), (12, "two words", "en", "c", 3), (13, "two words", "en", "a", 3),
    ]
    return [r + EXTRA for r in rows]


@pytest.fixture(scope="session")
def tables(spark, tmp_path_factory):
    """Writes frames as tables and reads them back, since operators that number rows take scans."""

    def stored(rows, schema=SCHEMA):
        path = str(tmp_path_factory.mktemp("table") / "t.parquet")
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(path)
        return spark.read.parquet(path)

    return stored


@pytest.fixture(scope="session")
def edge_docs(tables):
    return tables(edge_rows())


@pytest.fixture(scope="session")
def no_docs(tables):
    return tables([])

"""Every registered query against its SQL, at the smallest scale."""

import pytest
from check_oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from spinneret.plans.catalog import all_queries

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_has_its_sql():
    assert set(all_queries()) <= set(queries())
    assert set(all_queries()) <= set(oracle_sql()) <= set(queries())


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(all_queries()))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, queries()[name], oracle_sql()[name], SF_DIR) is None


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1

"""Every registered query against its SQL in DuckDB."""

import pytest
from compare import difference, duck

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = "/root/testdata/sf0.01"
QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, connection, name):
    assert difference(QUERIES[name](spark, SF_DIR), connection, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_sql(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry(spark).count() > 0

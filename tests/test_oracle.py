"""Every registered query against its SQL, or for rows alone where there is no SQL."""

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert compare(spark, con, FOLDER, QUERIES[name], SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)

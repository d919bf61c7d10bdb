"""All registered queries with SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, con, name):
    assert compare(spark, con, name, entry.queries()[name], SQL[name], SF_DIR) is None


def test_names_match():
    assert set(SQL) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["query_id", "doc_id", "score", "rank"]

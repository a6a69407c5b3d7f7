"""Every registered query against its SQL over the same tables."""

import os

import pytest
from compare import compare, connect

import __spark_entry__ as entry

FOLDER = os.environ.get("QUERY_TEST_FOLDER", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    problem, rows, _ = compare(con, spark, FOLDER, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert problem is None
    assert rows >= 0


def test_every_check_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.count() > 0
    assert {"user_id", "product_id", "score", "reason", "rank"} <= set(rows.columns)

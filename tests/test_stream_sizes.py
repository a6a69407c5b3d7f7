"""Registered streams whose micro-batches are cut small: the results stay those of their SQL."""

import os

import pytest
from compare import compare, connect

import __spark_entry__ as entry

FOLDER = os.environ.get("QUERY_TEST_FOLDER", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", ["x6_stream_profiles"])
def test_small_micro_batches(spark, monkeypatch, name):
    from clickloom.plans import stream_queries

    monkeypatch.setattr(stream_queries, "FILE_BYTES", 10_000)
    problem, rows, _ = compare(connect(FOLDER), spark, FOLDER, name, entry.queries()[name], entry.oracle_sql()[name])
    assert problem is None and rows

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture
def documents(spark):
    """Build a documents table, with columns whose names clash with those the operators use inside."""

    def build(rows):
        rows = [(i, t, "en", s, len(t or ""), 5, "x", "y", 1) for i, t, s in rows]
        return spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long, chunk int, kept string, node string, "
            "bucket long")

    return build

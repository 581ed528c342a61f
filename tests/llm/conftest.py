from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from itemstats.session import local_session  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark():
    return local_session("*", 8, app="llm-tests")


@pytest.fixture
def documents(spark):
    """documents from (doc_id, text) pairs, with columns whose names clash with the operators' own."""

    def make(rows, lang="en"):
        df = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t in rows], DOCS)
        for name in ("part", "row", "size", "key", "n", "u", "v"):
            df = df.selectExpr("*", f"1 AS {name}")
        return df

    return make

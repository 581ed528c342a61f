from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from itemstats.schema import RESPONSES  # noqa: E402
from itemstats.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", 8, app="itemstats-tests")
    yield s
    s.stop()


def responses(spark, rows, create_time="t1"):
    """rows: (paper_code, stu_code, item_id, score[, section[, attempt]])."""
    out = []
    for r in rows:
        paper, stu, item, score = r[:4]
        section = r[4] if len(r) > 4 else 1
        attempt = r[5] if len(r) > 5 else 1
        out.append((paper, create_time, stu, attempt, section, item, score))
    return spark.createDataFrame(out, RESPONSES)


def blueprint(spark, rows):
    """rows: (paper_code, section, kind, qty, full_mark)."""
    return spark.createDataFrame(rows, "paper_code string, section int, kind string, qty int, full_mark int")

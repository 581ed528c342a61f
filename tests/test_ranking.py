"""The distributed rank and the histogram cut equal a plain sort."""

from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from itemstats.operators.ranking import rank_in_group
from itemstats.operators.totals import high_low_groups


def _utf8_rank(keys):
    order = sorted(keys, key=lambda k: k.encode("utf-8"))
    return {k: i for i, k in enumerate(order)}


def test_rank_prefixes_and_unicode(spark):
    keys = ["1", "12", "123", "2", "", "a", "ab", "é", "éa", "z", "0001", "10"]
    df = spark.createDataFrame([("g", k) for k in keys] + [("h", k) for k in keys[:4]], "g string, k string")
    got = {(r.g, r.k): r["rank"] for r in rank_in_group(df, ["g"], F.col("k")).collect()}
    want = {("g", k): v for k, v in _utf8_rank(keys).items()}
    want.update({("h", k): v for k, v in _utf8_rank(keys[:4]).items()})
    assert got == want


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["x", "y"]), st.text("01ab", min_size=0, max_size=5)), min_size=1, max_size=40, unique=True))
def test_rank_matches_sort(spark, rows):
    df = spark.createDataFrame(rows, "g string, k string")
    got = {(r.g, r.k): r["rank"] for r in rank_in_group(df, ["g"], F.col("k")).collect()}
    want = {}
    for g in {g for g, _ in rows}:
        want.update({(g, k): v for k, v in _utf8_rank([k for gg, k in rows if gg == g]).items()})
    assert got == want


def _brute_groups(rows, fraction=0.27):
    """rows: (paper, stu, attempt, total|None) -> {(paper, stu, attempt): (is_high, is_low)}."""
    out = {}
    for p in {r[0] for r in rows}:
        rs = [r for r in rows if r[0] == p]
        n = len(rs)
        pg = int(n * fraction + 0.5)
        hi = sorted(rs, key=lambda r: (r[3] is None, -(r[3] or 0), r[1], r[2]))[:pg]
        lo = sorted(rs, key=lambda r: (r[3] is not None, r[3] or 0, r[1], r[2]))[:pg]
        hk, lk = {r[:3] for r in hi}, {r[:3] for r in lo}
        out.update({r[:3]: (r[:3] in hk, r[:3] in lk) for r in rs})
    return out


@settings(max_examples=5, deadline=None)
@given(st.integers(min_value=0, max_value=10_000))
def test_histogram_groups_match_sort(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for p in ("P", "Q"):
        for i in range(rnd.randint(1, 60)):
            total = None if rnd.random() < 0.1 else rnd.randint(0, 4)
            rows.append((p, f"{rnd.randint(0, 99):02d}{i:03d}", rnd.randint(1, 2), total))
    df = spark.createDataFrame(
        [(p, "t", s, a, t) for p, s, a, t in rows],
        "paper_code string, create_time string, stu_code string, attempt int, total_score int",
    )
    got = {(r.paper_code, r.stu_code, r.attempt): (r.is_high, r.is_low) for r in high_low_groups(df).collect()}
    assert got == _brute_groups(rows)

"""Batches that grow: merged moments against a full recomputation, replays, cuts through mass ties, the stream."""

from __future__ import annotations

import json
import os
import random
import tempfile

import pytest

from conftest import blueprint, responses
from itemstats.operators import growing, item_stats, paper_stats, reshape, totals
from itemstats.sinks import results
from itemstats.streaming import landing

BP = [("p", 1, "objective", 2, 2), ("p", 2, "subjective", 1, 5), ("q", 1, "subjective", 2, 3)]


def rows_of(rnd, paper, n, items, top, missing=0.1):
    out = []
    for s in range(n):
        out += [(paper, f"{paper}{s:04d}", i, rnd.choice([None, *range(top + 1)])) for i in range(1, items + 1) if rnd.random() > missing]
    return out


def key(row):
    return row["paper_code"], row["create_time"], row.asDict().get("item_id") or 0


def same(got, want):
    got, want = sorted(got.collect(), key=key), sorted(want.collect(), key=key)
    assert [key(r) for r in got] == [key(r) for r in want]
    for a, b in zip(got, want, strict=True):
        for c in b.asDict():
            x, y = a[c], b[c]
            assert (x is None) == (y is None) and (x == y or x == pytest.approx(y, rel=1e-9, abs=1e-9)), (key(a), c, x, y)


def full(sheets, items, missing):
    t = totals.total_score(sheets, items, missing)
    ii = item_stats.compute(sheets, items, missing)
    return ii, paper_stats.compute(t, ii, items)


@pytest.mark.parametrize("missing", ["propagate", "zero"])
def test_late_samples_equal_a_full_recomputation(spark, missing):
    rnd = random.Random(3)
    items = reshape.blueprint_items(blueprint(spark, BP))
    # few distinct totals, so both cuts run through ties; q is one mass tie with nulls; r has no blueprint
    rows = rows_of(rnd, "p", 60, 3, 2) + [("q", f"q{s:03d}", i, 1 if s % 5 else None) for s in range(40) for i in (1, 2)] + [("r", "r1", 1, 1)]
    rnd.shuffle(rows)
    part = {r[1]: rnd.randrange(3) for r in rows}
    state = tempfile.mkdtemp(prefix="itemstats-growing-")
    for epoch in (0, 1, 0, 2):  # epoch 0 is replayed
        given = reshape.answer_sheets(responses(spark, [r for r in rows if part[r[1]] == epoch]))
        touched = growing.add(given, items, state, epoch, missing)
        assert {r["paper_code"] for r in touched.collect()} <= {"p", "q"}
    sheets = reshape.answer_sheets(responses(spark, rows))
    ii, pi = full(sheets, items, missing)
    got = growing.statistics(spark, state, items)
    same(got[0], ii)
    same(got[1], pi)
    # one batch alone
    only = spark.createDataFrame([("q", "t1")], "paper_code string, create_time string")
    got = growing.statistics(spark, state, items, only)
    same(got[0], ii.filter("paper_code = 'q'"))
    same(got[1], pi.filter("paper_code = 'q'"))


def test_state_without_samples(spark):
    items = reshape.blueprint_items(blueprint(spark, BP))
    state = tempfile.mkdtemp(prefix="itemstats-growing-")
    growing.add(reshape.answer_sheets(responses(spark, [("r", "x", 1, 1)])), items, state, 0)
    ii, pi = growing.statistics(spark, state, items)
    assert ii.collect() == [] and pi.collect() == []


def land(root, ts, rows):
    os.makedirs(f"{root}/p", exist_ok=True)
    with open(f"{root}/p/data.{ts}", "w", encoding="utf-8") as f:
        for student, a, b, c in rows:
            f.write(json.dumps({"stuCode": student, "paperCode": "p", "item1": {"i1": a, "i2": b}, "item2": {"i3": c}}) + "\n")


def test_stream_of_late_files(spark):
    """Files of one day are one batch; a restart reads only what landed since and brings the batch up to date."""
    rnd = random.Random(9)
    bp = blueprint(spark, BP)
    items = reshape.blueprint_items(bp)
    root, out, ck, state = (tempfile.mkdtemp(prefix="itemstats-follow-") for _ in range(4))
    sheets = []
    for ts in ("1551231000", "1551232000"):
        rows = [(f"{ts[-4:]}{s:03d}", rnd.randrange(3), rnd.randrange(3), rnd.randrange(6) / 2) for s in range(25)]
        land(root, ts, rows)
        sheets += rows
        q = landing.follow(spark, root, bp, out, state, lambda ts: ts.substr(1, 5), checkpoint=ck, available_now=True)
        assert q.awaitTermination(300) and q.exception() is None
        cells = [("p", "15512", r[0], 1, {1: float(r[1]), 2: float(r[2]), 3: r[3]}) for r in sheets]
        df = spark.createDataFrame(cells, "paper_code string, create_time string, stu_code string, attempt int, cells map<int,double>")
        ii, pi = full(df, items, "propagate")
        same(results.read_result(spark, f"{out}/t_item_index"), ii)
        same(results.read_result(spark, f"{out}/t_paper_index"), pi)
    assert sorted(f for f in os.listdir(f"{state}/samples/paper_code=p/create_time=15512")) == ["epoch=0", "epoch=1"]

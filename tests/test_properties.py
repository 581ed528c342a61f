"""Properties from SURVEY §5 on the driver's tables: ranges, invariances, partition independence."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from itemstats.operators import item_stats, paper_stats, reshape, totals
from itemstats.sources import fixture

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables missing")


def _stats(spark, responses, missing="zero"):
    items = reshape.blueprint_items(fixture.blueprint(spark, SF_SMALL))
    sheets = reshape.answer_sheets(responses).checkpoint()
    t = totals.total_score(sheets, items, missing)
    g = totals.high_low_groups(t)
    ii = item_stats.from_groups(g, items).checkpoint()
    return g, ii, paper_stats.compute(g, ii, items)


def test_ranges_and_group_sizes(spark):
    g, ii, pi = _stats(spark, fixture.responses(spark, SF_SMALL))
    rows = ii.collect()
    assert all(0 <= r.nandu <= 1 for r in rows)
    kinds = {r.item_id: r.kind for r in reshape.blueprint_items(fixture.blueprint(spark, SF_SMALL)).collect()}
    assert all(-1 <= r.qufendu <= 1 for r in rows if kinds[r.item_id] == "objective")
    sizes = {(r.paper_code, r.create_time): r.pg for r in totals.group_sizes(g).collect()}
    for (paper, ct), pg in sizes.items():
        mine = g.filter((F.col("paper_code") == paper) & (F.col("create_time") == ct))
        assert mine.filter("is_high").count() == pg and mine.filter("is_low").count() == pg


def test_alpha_unchanged_by_a_constant_on_an_item(spark):
    r = fixture.responses(spark, SF_SMALL)
    shifted = r.withColumn("score", F.when(F.col("item_id") == 4, F.col("score") + 1).otherwise(F.col("score")))
    # with missing cells propagating, every counted total and every present cell moves by the constant
    _, _, a = _stats(spark, r, "propagate")
    _, _, b = _stats(spark, shifted, "propagate")
    xa = {x.paper_code: x.xindu for x in a.collect()}
    xb = {x.paper_code: x.xindu for x in b.collect()}
    assert xa.keys() == xb.keys() and all(abs(xa[k] - xb[k]) < 1e-9 for k in xa)


def test_results_do_not_depend_on_partitioning(spark):
    r = fixture.responses(spark, SF_SMALL)
    _, a, _ = _stats(spark, r)
    _, b, _ = _stats(spark, r.repartition(7, "item_id"))
    key = lambda x: (x.paper_code, x.item_id)
    ra = sorted(a.collect(), key=key)
    rb = sorted(b.collect(), key=key)
    assert len(ra) == len(rb)
    for x, y in zip(ra, rb):
        assert key(x) == key(y) and x.max_score == y.max_score and abs(x.qufendu - y.qufendu) < 1e-12
        assert abs(x.fc_score - y.fc_score) < 1e-9

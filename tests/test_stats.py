"""Hand-computed item and paper statistics."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from conftest import blueprint, responses
from itemstats.operators import item_stats, paper_stats, reshape, totals

BP = [("P", 1, "objective", 2, 2), ("P", 2, "subjective", 1, 10)]
# student -> (i1, i2, i3); totals 14, 8, 6, 2
SCORES = {"A": (2, 2, 10), "B": (2, 0, 6), "C": (0, 2, 4), "D": (0, 0, 2)}


def _rows(scores, paper="P"):
    return [(paper, s, i + 1, v, 1 if i < 2 else 2) for s, vals in scores.items() for i, v in enumerate(vals) if v is not None]


def _run(spark, scores, bp=BP, missing="propagate"):
    r = responses(spark, _rows(scores))
    items = reshape.blueprint_items(blueprint(spark, bp))
    sheets = reshape.answer_sheets(r)
    t = totals.total_score(sheets, items, missing)
    g = totals.high_low_groups(t)
    ii = item_stats.from_groups(g, items)
    pi = paper_stats.compute(g, ii, items)
    return g, ii, pi


def test_item_and_paper_formulas(spark):
    g, ii, pi = _run(spark, SCORES)
    groups = {r.stu_code: (r.total_score, r.is_high, r.is_low) for r in g.collect()}
    assert groups == {"A": (14, True, False), "B": (8, False, False), "C": (6, False, False), "D": (2, False, True)}
    got = {r.item_id: r for r in ii.collect()}
    assert (got[1].max_score, got[1].min_score) == (2, 0)
    assert got[1].avg_score == pytest.approx(1.0) and got[1].fc_score == pytest.approx(1.0)
    assert got[1].nandu == pytest.approx(0.5) and got[1].qufendu == pytest.approx(1.0)
    assert got[3].fc_score == pytest.approx(8.75) and got[3].bzc_score == pytest.approx(math.sqrt(8.75))
    assert got[3].nandu == pytest.approx(0.55) and got[3].qufendu == pytest.approx(1.0)
    p = pi.collect()[0]
    assert (p.max_score, p.min_score) == (14, 2)
    assert p.avg_score == pytest.approx(7.5) and p.fc_score == pytest.approx(18.75)
    assert p.xindu == pytest.approx(1.5 * (1 - 10.75 / 18.75))
    assert p.nandu == pytest.approx((0.5 + 0.5 + 0.55) / 3) and p.qufendu == pytest.approx(1.0)


def test_missing_cell_propagates_and_sorts_low(spark):
    scores = dict(SCORES, E=(2, 2, None))
    g, ii, _ = _run(spark, scores)
    rows = {r.stu_code: r for r in g.collect()}
    assert rows["E"].total_score is None
    # n = 5 -> pg = round(1.35) = 1; null total comes first ascending
    assert rows["E"].is_low and not rows["D"].is_low and rows["A"].is_high
    item3 = [r for r in ii.collect() if r.item_id == 3][0]
    assert item3.avg_score == pytest.approx(5.5)          # null skipped
    assert item3.nandu == pytest.approx(22 / 10 / 5)      # null counts 0 in difficulty


def test_missing_zero_mode(spark):
    scores = dict(SCORES, E=(2, 2, None))
    g, _, _ = _run(spark, scores, missing="zero")
    assert {r.stu_code: r.total_score for r in g.collect()}["E"] == 4


def test_ties_break_by_code_and_all_equal(spark):
    scores = {s: (1, 1, 5) for s in ["d", "b", "a", "c"]}
    g, ii, pi = _run(spark, scores)
    rows = {r.stu_code: (r.is_high, r.is_low) for r in g.collect()}
    assert rows == {"a": (True, True), "b": (False, False), "c": (False, False), "d": (False, False)}
    item3 = [r for r in ii.collect() if r.item_id == 3][0]
    assert item3.qufendu is None                    # max == min: no spread
    assert pi.collect()[0].xindu is None            # zero total variance


def test_one_student_and_one_item(spark):
    g, ii, pi = _run(spark, {"A": (1, 0, 3)})
    assert [(r.is_high, r.is_low, r.pg) for r in g.collect()] == [(False, False, 0)]
    assert all(r.qufendu is None for r in ii.collect())
    r = responses(spark, [("Q", "s1", 1, 3), ("Q", "s2", 1, 1)])
    items = reshape.blueprint_items(blueprint(spark, [("Q", 1, "subjective", 1, 4)]))
    pi = paper_stats.compute(totals.total_score(reshape.answer_sheets(r), items),
                             item_stats.compute(reshape.answer_sheets(r), items), items)
    assert pi.collect()[0].xindu is None            # k = 1


def test_sections_without_objective_or_subjective_and_many_sections(spark):
    only_subj = [("S", 1, "subjective", 1, 5), ("S", 2, "subjective", 2, 5)]
    only_obj = [("O", 1, "objective", 3, 1)]
    six = [("X", k, "objective" if k <= 2 else "subjective", 1, k) for k in range(1, 7)]
    bp = blueprint(spark, only_subj + only_obj + six)
    items = reshape.blueprint_items(bp)
    assert sorted((r.paper_code, r.item_id, r.section) for r in items.collect() if r.paper_code == "X") == [
        ("X", k, k) for k in range(1, 7)
    ]
    rows = [("S", s, i, v) for s, v in [("a", 1), ("b", 4)] for i in (1, 2, 3)]
    rows += [("O", s, i, v) for s, v in [("a", 0), ("b", 1)] for i in (1, 2, 3)]
    rows += [("X", s, i, v) for s, v in [("a", 0), ("b", 1)] for i in range(1, 7)]
    ii = item_stats.compute(reshape.answer_sheets(responses(spark, rows)), items)
    assert ii.count() == 3 + 3 + 6


def test_many_papers_equal_each_alone(spark):
    bp = BP + [("R", 1, "objective", 2, 2), ("R", 2, "subjective", 1, 10)]
    rows = _rows(SCORES) + _rows({"w": (0, 2, 3), "x": (2, 2, 9), "y": (0, 0, 0)}, paper="R")
    items = reshape.blueprint_items(blueprint(spark, bp))
    both = item_stats.compute(reshape.answer_sheets(responses(spark, rows)), items)
    alone = item_stats.compute(reshape.answer_sheets(responses(spark, _rows(SCORES))), items)
    key = lambda r: (r.paper_code, r.item_id)
    p_both = sorted([tuple(r) for r in both.filter(F.col("paper_code") == "P").collect()], key=str)
    p_alone = sorted([tuple(r) for r in alone.collect()], key=str)
    assert p_both == p_alone
    assert len({key(r) for r in both.collect()}) == 6


def test_group_sizes_round_half_up(spark):
    # 150 * 0.27 = 40.5 -> 41 (half up, as the reference's round)
    rows = [("P", f"s{i:03d}", 1, i % 7, 1) for i in range(150)]
    items = reshape.blueprint_items(blueprint(spark, [("P", 1, "objective", 1, 10)]))
    t = totals.total_score(reshape.answer_sheets(responses(spark, rows)), items)
    assert totals.group_sizes(t).collect()[0].pg == 41
    g = totals.high_low_groups(t)
    assert g.filter("is_high").count() == 41 and g.filter("is_low").count() == 41

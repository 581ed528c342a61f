"""Nothing is lost without a word: parsing by cell, rejects, papers of any width, chosen files, stale batches."""

from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import blueprint, responses
from itemstats.functions import sizing
from itemstats.operators import clusters, item_stats, paper_stats, reshape, rules, totals
from itemstats.sinks import results
from itemstats.sources import batches
from itemstats.sources import responses as src

LINES = [
    '{"stuCode":"s1","paperCode":"P","item1":{"i1":2,"i2":2.5},"item2":{"i3":"3"}}',
    '{"stuCode":"s2","paperCode":"P","item1":{"i1":2.0,"i2":"x"},"item2":"broken"}',
    '{"stuCode":"s3","paperCode":"Q","item1":{"i1":null}}',
    '{"paperCode":"P","item1":{"i1":1}}',
    "not json",
]


def _lines(spark):
    return spark.createDataFrame([(x, "t") for x in LINES], "value string, create_time string")


@pytest.mark.parametrize("kind,half", [("double", 2.5), ("int", None)])
def test_scores_are_read_cell_by_cell(spark, kind, half):
    rows = src.to_long(_lines(spark), score_type=kind).collect()
    got = {(r.paper_code, r.stu_code, r.item_id): r.score for r in rows}
    assert got == {("P", "s1", 1): 2, ("P", "s1", 2): half, ("P", "s1", 3): 3, ("P", "s2", 1): 2, ("P", "s2", 2): None, ("Q", "s3", 1): None}
    sheets = {r.stu_code: r.cells for r in src.to_sheets(_lines(spark), score_type=kind).collect()}
    assert sheets == {"s1": {1: 2, 2: half, 3: 3}, "s2": {1: 2, 2: None}, "s3": {1: None}}


def test_rejected_counts_what_is_not_used(spark):
    got = {r.reason: r.n for r in src.rejected(_lines(spark), paper_code=F.lit("P")).collect()}
    assert got == {"malformed line": 1, "no stuCode": 1, "unreadable section": 1, "unreadable score": 2, "other paperCode": 1}
    assert {r.paper_code for r in src.to_long(_lines(spark), paper_code=F.lit("P")).collect()} == {"P"}


def test_a_score_beats_a_null_for_an_item_given_twice(spark):
    df = spark.createDataFrame([('{"stuCode":"s","paperCode":"P","item1":{"i1":null},"item2":{"i1":4}}', "t")], "value string, create_time string")
    assert src.to_sheets(df).collect()[0].cells == {1: 4}


def test_fractional_scores_through_the_statistics(spark):
    items = reshape.blueprint_items(blueprint(spark, [("P", 1, "subjective", 2, 4)]))
    df = spark.createDataFrame(
        [(f'{{"stuCode":"s{i}","paperCode":"P","item1":{{"i1":{i / 2},"i2":1}}}}', "t") for i in range(5)], "value string, create_time string"
    )
    sheets = src.to_sheets(df, score_type="double")
    t = totals.total_score(sheets, items)
    assert sorted(r.total_score for r in t.collect()) == [1.0, 1.5, 2.0, 2.5, 3.0]
    ii = {r.item_id: r for r in item_stats.compute(sheets, items).collect()}
    assert ii[1].avg_score == 1.0 and ii[1].nandu == 0.25


def test_item_nobody_answered_and_zero_mode(spark):
    items = reshape.blueprint_items(blueprint(spark, [("P", 1, "subjective", 3, 4)]))
    rows = [("P", "a", 1, 4), ("P", "a", 2, 2), ("P", "b", 1, 2), ("P", "c", 1, 0), ("P", "c", 2, 4)]
    sheets = reshape.answer_sheets(responses(spark, rows))
    ii = {r.item_id: r for r in item_stats.compute(sheets, items).collect()}
    assert ii[3].avg_score is None and ii[3].nandu is None and ii[2].avg_score == 3.0
    grouped = totals.high_low_groups(totals.total_score(sheets, items, "zero"))
    zero = {r.item_id: r for r in item_stats.from_groups(grouped, items).collect()}
    assert zero[2].avg_score == 2.0 and zero[3].max_score == 0
    p = paper_stats.compute(grouped, item_stats.from_groups(grouped, items), items).collect()[0]
    sums = [6, 2, 4]
    var = sum((x - 4) ** 2 for x in sums) / 3
    items_var = 8 / 3 + 8 / 3 + 0
    assert abs(p.xindu - 1.5 * (1 - items_var / var)) < 1e-9
    feats = clusters.features(sheets, items, missing="zero").collect()
    assert sorted(r.scores for r in feats) == [[0.0, 4.0, 0.0], [2.0, 0.0, 0.0], [4.0, 2.0, 0.0]]
    out = {(r.stu_code, r.reason) for r in clusters.left_out(sheets, items, include_code=True).collect()}
    assert out == {(s, "missing cell") for s in "abc"} | {(s, "no numeric code") for s in "abc"}


def test_clusters_of_papers_with_2_3_and_60_items(spark):
    bp = [("A", 1, "subjective", 2, 5), ("B", 1, "subjective", 3, 5), ("C", 1, "subjective", 60, 5)]
    items = reshape.blueprint_items(blueprint(spark, bp))
    rows = [(p, f"s{i}", k + 1, 5 * (i % 2)) for p, n in (("A", 2), ("B", 3), ("C", 60)) for i in range(8) for k in range(n)]
    sheets = reshape.answer_sheets(responses(spark, rows))
    prof, assigned = clusters.run(sheets, items, k=2)
    got = {(r.paper_code, r.stu_code): r.cluster for r in assigned.collect()}
    assert got == {(p, f"s{i}"): i % 2 for p in "ABC" for i in range(8)} and prof.count() == 24


def test_rules_do_not_depend_on_the_fit_groups(spark, monkeypatch):
    rows = [(f"P{b}", f"{i}", [f"{k}t" for k in range(5) if (i * 7 + k * b) % 3]) for b in range(6) for i in range(12)]
    tx = spark.createDataFrame([(p, "t", s, x) for p, s, x in rows], "paper_code string, create_time string, stu_code string, items array<string>")
    key = lambda df: sorted((r.paper_code, tuple(r["items"]), r.freq, r.n) for r in df.collect())
    one = key(rules.fitted_itemsets(tx, 0.3))
    monkeypatch.setattr(rules, "FIT_LABELS", 5)
    assert key(rules.fitted_itemsets(tx, 0.3)) == one and one


def test_broadcast_is_bounded_by_bytes(spark):
    df = spark.createDataFrame([(1, [0.5] * 1000)], "a int, b array<double>")
    rows, size = sizing.measured(df)
    assert rows == 1 and size > 4000
    assert "broadcast" in sizing.small_side(df)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in sizing.small_side(df, 1000)._jdf.queryExecution().logical().toString().lower()


def _landing(papers):
    root = tempfile.mkdtemp(prefix="itemstats-landing-")
    for paper, files in papers.items():
        os.makedirs(f"{root}/{paper}")
        for ts, lines in files.items():
            with open(f"{root}/{paper}/data.{ts}", "w", encoding="utf-8") as f:
                f.write("\n".join(lines) + "\n")
    return root


def test_only_chosen_files_are_read(spark):
    line = '{{"stuCode":"{}","paperCode":"{}","item1":{{"i1":{}}}}}'.format
    names = ["P A", "prüfung+ß", "q[1]%20"]
    root = _landing({p: {"100": [line("old", p, 1)], "200": [line("new", p, 1.5), line("x", "other", 2)], "300": ["junk"]} for p in names})
    req = spark.createDataFrame([(p, "150") for p in names] + [("none", "150")], "paper_code string, submit_time string")
    df = batches.read_requested(spark, root, req)
    got = sorted((r.paper_code, r.create_time, r.stu_code, r.score) for r in df.collect())
    assert got == sorted((p, "150", s, v) for p in names for s, v in (("new", 1.5), ("x", 2.0)))
    assert {os.path.basename(f) for f in df.inputFiles() if "data." in f} <= {"data.200"}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(uri" not in plan and "hashpartitioning(path" not in plan
    rejects = {r.reason: r.n for r in batches.requested_rejects(spark, root, req).collect()}
    assert rejects == {"other paperCode": 3, "no file": 1}
    none = spark.createDataFrame([("none", "1")], "paper_code string, submit_time string")
    assert batches.read_requested(spark, root, none, as_sheets=True).count() == 0


@pytest.mark.parametrize("as_table", [False, True])
def test_rerun_with_fewer_and_with_no_rows(spark, as_table):
    schema = "paper_code string, create_time string, pre_order string, suf_order string, confidence double"
    target = tempfile.mkdtemp(prefix="itemstats-fpg-") + "/t_item_fpg"
    if as_table:
        results.ensure_tables(spark, "itemstats_stale", tempfile.mkdtemp(prefix="itemstats-stale-"))
        target = "itemstats_stale.t_item_fpg"
    rows = [("P'1", "1", str(i), "9", 0.9) for i in range(4)] + [("Q/2", "1", "1", "2", 0.5), ("R", "1", "1", "2", 0.5)]
    both = spark.createDataFrame([("P'1", "1"), ("Q/2", "1")], "paper_code string, create_time string")
    full = spark.createDataFrame(rows, schema)
    results.write_result(full, target, as_table, full)
    assert results.read_result(spark, target, as_table=as_table).count() == 6
    spark.catalog.clearCache()
    results.write_result(full.filter("paper_code = 'Q/2'"), target, as_table, both)
    spark.catalog.refreshByPath(target) if not as_table else spark.catalog.refreshTable(target)
    assert sorted(r.paper_code for r in results.read_result(spark, target, as_table=as_table).collect()) == ["Q/2", "R"]
    results.write_result(full.limit(0), target, as_table, both)
    spark.catalog.refreshByPath(target) if not as_table else spark.catalog.refreshTable(target)
    assert [r.paper_code for r in results.read_result(spark, target, as_table=as_table).collect()] == ["R"]


def test_a_batch_is_written_as_few_files(spark):
    target = tempfile.mkdtemp(prefix="itemstats-files-") + "/t"
    df = spark.range(4000).repartition(8).selectExpr("concat('P', id % 5) AS paper_code", "'1' AS create_time", "cast(id AS int) AS item_id")
    results.write_result(df, target)
    files = [f for _, _, names in os.walk(target) for f in names if f.endswith(".parquet")]
    assert len(files) <= 10

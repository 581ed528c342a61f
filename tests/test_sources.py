"""Sources: nested JSON to long rows, batch files, wide blueprints."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import functions as F

from itemstats.operators import reshape
from itemstats.sources import batches, responses as json_source, tables


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


LINES = "\n".join([
    '{"stuCode":"01020304","paperCode":"77","item1":{"i1":2,"i2":0},"item2":{"i3":5}}',
    '{"stuCode":"01020305","paperCode":77,"item1":{"i1":1},"item2":{"i3":null}}',
    'this is not json',
    '{"stuCode":"01020304","paperCode":"77","item1":{"i1":0,"i2":2},"item2":{"i3":1}}',
])


def test_json_to_long(spark):
    root = tempfile.mkdtemp(prefix="itemstats-json-")
    _write(f"{root}/77/data.1551231000", LINES + "\n")
    r = json_source.read_responses(spark, f"{root}/77/data.1551231000")
    rows = sorted(tuple(x) for x in r.collect())
    assert ("77", "1551231000", "01020305", 1, 2, 3, None) in rows          # null cell kept
    assert not any(x[2] == "01020305" and x[5] == 2 for x in rows)            # missing item: no row
    assert {x[3] for x in rows if x[2] == "01020304"} == {1, 2}               # a repeated student: two attempts
    assert len(rows) == 3 + 2 + 3
    sheets = json_source.read_sheets(spark, f"{root}/77/data.1551231000")
    as_rows = sheets.select("stu_code", "attempt", F.explode("cells").alias("item_id", "score"))
    assert sorted(tuple(x) for x in as_rows.collect()) == sorted((x[2], x[3], x[5], x[6]) for x in rows)
    dup = spark.createDataFrame([("P", "t", "s", 1, 1, 1, 3), ("P", "t", "s", 1, 1, 1, 2)],
                                "paper_code string, create_time string, stu_code string, attempt int, section int, item_id int, score int")
    assert reshape.answer_sheets(dup).collect()[0].cells == {1: 2}      # a repeated cell does not fail the job
    last = reshape.latest_attempt(r)
    assert sorted((x.stu_code, x.attempt, x.item_id, x.score) for x in last.collect()) == [
        ("01020304", 2, 1, 0), ("01020304", 2, 2, 2), ("01020304", 2, 3, 1), ("01020305", 1, 1, 1), ("01020305", 1, 3, None)]
    items = reshape.blueprint_items(
        spark.createDataFrame([("77", 1, "objective", 2, 2), ("77", 2, "subjective", 1, 5)],
                              "paper_code string, section int, kind string, qty int, full_mark int"))
    comp = reshape.complete(reshape.answer_sheets(r), items)
    assert comp.count() == 3 * 3 and comp.filter(F.col("score").isNull()).count() == 2


def test_select_batch_on_files(spark):
    root = tempfile.mkdtemp(prefix="itemstats-land-") + "/host.10.0.0.1"
    for name in ["data.20190227100000", "data.20190227120000", "data.20190227130000.tmp", "notes.txt"]:
        _write(f"{root}/77/{name}", LINES + "\n")
    _write(f"{root}/88/data.20190101000000", LINES + "\n")
    files = batches.list_batches(spark, root)
    assert sorted(r.ts for r in files.collect()) == ["20190101000000", "20190227100000", "20190227120000"]
    req = spark.createDataFrame(
        [("77", "20190227090000"), ("77", "20190227100000"), ("77", "20190227110000"), ("77", "20190301000000"),
         ("88", "20180101000000"), ("99", "20190101000000")], "paper_code string, submit_time string")
    got = {(r.paper_code, r.submit_time): r.create_time for r in batches.select_batch(files, req).collect()}
    assert got == {
        ("77", "20190227090000"): "20190227100000",
        ("77", "20190227100000"): "20190227100000",   # equal counts as not before
        ("77", "20190227110000"): "20190227120000",
        ("77", "20190301000000"): "20190227120000",   # none late enough: the latest
        ("88", "20180101000000"): "20190101000000",
        ("99", "20190101000000"): None,               # no file at all
    }
    r = batches.read_requested(spark, root, req.filter(F.col("paper_code") == "77"))
    assert {x.create_time for x in r.collect()} == {"20190227090000", "20190227100000", "20190227110000", "20190301000000"}


def test_wide_blueprint(spark):
    wide = spark.createDataFrame(
        [("1", 2, 1, 1, 3, 2, 2, 5, None, None), ("2", 1, 0, 1, 4, None, 10, None, None, None),
         ("3", 3, 3, 0, 1, 1, 1, 1, 1, 1)],
        "paper_code string, all_items int, o_items int, s_items int, part1_qty int, part2_qty int, "
        "part1_mark int, part2_mark int, part3_qty int, part3_mark int")
    bp = tables.wide_blueprint(wide)
    got = sorted(tuple(r) for r in bp.collect())
    assert got == [("1", 1, "objective", 3, 2), ("1", 2, "subjective", 2, 5), ("2", 1, "subjective", 4, 10),
                   ("3", 1, "objective", 1, 1), ("3", 2, "objective", 1, 1), ("3", 3, "objective", 1, 1)]
    items = sorted((r.paper_code, r.item_id, r.section, r.full_mark) for r in reshape.blueprint_items(bp).collect())
    assert [x for x in items if x[0] == "1"] == [("1", 1, 1, 2), ("1", 2, 1, 2), ("1", 3, 1, 2), ("1", 4, 2, 5), ("1", 5, 2, 5)]


def test_blueprint_from_json_file(spark):
    root = tempfile.mkdtemp(prefix="itemstats-bp-")
    _write(f"{root}/x_p", '{"paper_code":"5","all_items":1,"o_items":1,"s_items":0,"part1_qty":2,"part1_mark":3}\n')
    bp = tables.read_blueprint(spark, f"{root}/x_p")
    assert [tuple(r) for r in bp.collect()] == [("5", 1, "objective", 2, 3)]


def test_attempts_for_a_code_shared_by_many_lines(spark):
    # a junk code on many lines: every line stays its own sample, numbered in file order
    root = tempfile.mkdtemp(prefix="itemstats-hot-")
    body = "\n".join(f'{{"stuCode":"","paperCode":"9","item1":{{"i1":{i}}}}}' for i in range(40))
    body += '\n{"stuCode":"x","paperCode":"9","item1":{"i1":7}}\n'
    _write(f"{root}/9/data.1", body)
    sheets = json_source.read_sheets(spark, f"{root}/9/data.1")
    got = {(r.stu_code, r.attempt): r.cells[1] for r in sheets.collect()}
    assert got == {**{("", i + 1): i for i in range(40)}, ("x", 1): 7}


def test_select_batch_same_for_any_partitioning(spark):
    from conftest import SF_SMALL
    from itemstats.sources import fixture

    files, req = fixture.batch_requests(spark, SF_SMALL)
    files = batches.batch_files(files)
    runs = [{tuple(r) for r in batches.select_batch(files, req, partitions=n).collect()} for n in (1, 3, 64)]
    assert runs[0] == runs[1] == runs[2] and len(runs[0]) == req.count()

"""Sinks: idempotent batch overwrite, read-back pruning, narrow decimals, delimited text, JDBC."""

from __future__ import annotations

import os
import tempfile

from itemstats.sinks import external, results


def _df(spark, rows):
    return spark.createDataFrame(rows, "paper_code string, create_time string, item_id int, nandu double")


def test_dynamic_overwrite_is_idempotent(spark):
    target = tempfile.mkdtemp(prefix="itemstats-out-") + "/t_item_index"
    a = _df(spark, [("P", "1", 1, 0.5), ("P", "1", 2, 0.25), ("Q", "1", 1, 0.75)])
    results.write_result(a, target)
    results.write_result(a, target)                       # a re-run does not duplicate
    assert spark.read.parquet(target).count() == 3
    results.write_result(_df(spark, [("P", "1", 1, 0.1), ("0123", "1", 1, 0.2)]), target)   # replaces batch P/1 only
    back = results.read_result(spark, target, paper_code="Q", create_time="1")
    assert [(r.item_id, r.nandu) for r in back.collect()] == [(1, 0.75)]
    assert "PartitionFilters" in back._jdf.queryExecution().executedPlan().toString() or back.count() == 1
    assert spark.read.parquet(target).count() == 3
    assert {r.paper_code for r in results.read_result(spark, target).collect()} == {"P", "Q", "0123"}


def test_narrow_decimals(spark):
    df = spark.createDataFrame([(1.23456, 12.5)], "nandu double, fc_score double")
    r = results.narrow(df, "t_item_index").collect()[0]
    assert str(r.nandu) == "1.235" and r.fc_score is None      # 12.5 does not fit decimal(4,3)


def test_ensure_tables_and_insert(spark):
    db = "itemstats_test_db"
    loc = tempfile.mkdtemp(prefix="itemstats-wh-")
    results.ensure_tables(spark, db, loc)
    df = spark.createDataFrame([("P", "1", "s1", 1, 10)], "paper_code string, create_time string, stu_code string, attempt int, total_score int")
    results.write_result(df, f"{db}.t_score_total", as_table=True)
    results.write_result(df, f"{db}.t_score_total", as_table=True)
    assert spark.table(f"{db}.t_score_total").count() == 1


def test_delimited_keeps_positions(spark):
    df = spark.createDataFrame([("a", None, 3)], "x string, y string, z int")
    assert external.delimited(df, "|").collect()[0].value == "a||3"
    assert external.delimited(df, "|", keep_nulls=False).collect()[0].value == "a|3"
    out = tempfile.mkdtemp(prefix="itemstats-txt-") + "/d"
    external.write_delimited(df, out, ",")
    assert [r.value for r in spark.read.text(out).collect()] == ["a,,3"]


def test_jdbc_round_trip_embedded_derby(spark):
    # an in-memory database inside the Spark JVM: no server, no port
    url = "jdbc:derby:memory:itemstats_test;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.createDataFrame([("1,3", "5", 0.9, "P", "1")],
                               "pre_order string, suf_order string, confidence double, paper_code string, create_time string")
    external.write_jdbc(df, url, "T_ITEM_FPG", props)
    back = spark.read.jdbc(url, "T_ITEM_FPG", properties=props)
    assert [tuple(r) for r in back.collect()] == [("1,3", "5", 0.9, "P", "1")]
    assert os.path.exists(tempfile.gettempdir())


def test_blueprint_over_jdbc_embedded_derby(spark):
    from itemstats.sources import tables

    url = "jdbc:derby:memory:itemstats_bp;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    wide = spark.createDataFrame([("77", 2, 1, 1, 3, 2, 2, 5)],
                                 "paper_code string, all_items int, o_items int, s_items int, "
                                 "part1_qty int, part2_qty int, part1_mark int, part2_mark int")
    external.write_jdbc(wide, url, "T_PAPER_ITEM", props, createTableColumnTypes="paper_code VARCHAR(32)")
    bp = tables.read_blueprint(spark, "T_PAPER_ITEM", url=url, **props)
    selected = bp.where("paper_code = '77'")                # pushed down to the database
    got = sorted(tuple(r) for r in selected.collect())
    assert got == [("77", 1, "objective", 3, 2), ("77", 2, "subjective", 2, 5)]

"""End to end: the pipeline over the driver's tables, the landing stream, and the oracle queries."""

from __future__ import annotations

import os
import shutil
import sys
import tempfile

import duckdb
import pytest

from conftest import SF_SMALL
import __spark_entry__ as entry
from itemstats.plans import pipeline
from itemstats.sinks import results
from itemstats.sources import fixture
from itemstats.streaming import landing

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check_oracle import TABLES, digest  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables missing")


def test_pipeline_writes_all_results(spark):
    out = tempfile.mkdtemp(prefix="itemstats-pipe-")
    opts = pipeline.Options(knowledge_support=0.45, item_rules=True, item_support=0.3)
    res = pipeline.run(fixture.responses(spark, SF_SMALL), fixture.blueprint(spark, SF_SMALL), out,
                       fixture.item_knowledge(spark, SF_SMALL), steps="123", options=opts)
    assert set(res) == {"t_score_total", "t_item_index", "t_paper_index", "t_item_fpg", "t_item_cluster"}
    assert spark.read.parquet(f"{out}/t_item_index").count() == 35
    assert spark.read.parquet(f"{out}/t_paper_index").count() == 5
    assert spark.read.parquet(f"{out}/t_score_total").count() == 150
    only = pipeline.analyse(fixture.responses(spark, SF_SMALL), fixture.blueprint(spark, SF_SMALL), steps="1",
                            requests=spark.createDataFrame([("AUTOMOBILE", fixture.CREATE_TIME)], "paper_code string, create_time string"))
    assert only["t_paper_index"].count() == 1 and set(only) == {"t_score_total", "t_item_index", "t_paper_index"}


def test_landing_stream(spark):
    root = tempfile.mkdtemp(prefix="itemstats-stream-")
    out = tempfile.mkdtemp(prefix="itemstats-stream-out-")
    lines = fixture.as_json_lines(fixture.responses(spark, SF_SMALL)).filter("value like '%\"AUTOMOBILE\"%'")
    tmp = tempfile.mkdtemp(prefix="itemstats-stream-src-")
    lines.select("value").coalesce(1).write.mode("overwrite").text(tmp)
    part = [f for f in os.listdir(tmp) if f.startswith("part-")][0]
    os.makedirs(f"{root}/AUTOMOBILE")
    shutil.copy(f"{tmp}/{part}", f"{root}/AUTOMOBILE/data.1551231000")
    shutil.copy(f"{tmp}/{part}", f"{root}/AUTOMOBILE/data.1551239999.tmp")
    ck = tempfile.mkdtemp(prefix="itemstats-stream-ck-")
    q = landing.watch(spark, root, fixture.blueprint(spark, SF_SMALL), out, steps="1", checkpoint=ck, available_now=True)
    q.awaitTermination(300)
    got = results.read_result(spark, f"{out}/t_item_index")
    assert got.count() == 7 and {r.create_time for r in got.collect()} == {"1551231000"}
    # a later file: a restart from the same checkpoint processes only it, nothing is duplicated
    shutil.copy(f"{tmp}/{part}", f"{root}/AUTOMOBILE/data.1551240000")
    q = landing.watch(spark, root, fixture.blueprint(spark, SF_SMALL), out, steps="1", checkpoint=ck, available_now=True)
    q.awaitTermination(300)
    got = results.read_result(spark, f"{out}/t_item_index")
    assert got.count() == 14 and {r.create_time for r in got.collect()} == {"1551231000", "1551240000"}
    per_batch = results.read_result(spark, f"{out}/t_score_total").groupBy("create_time").count().collect()
    assert len({r["count"] for r in per_batch}) == 1                      # both batches hold the same students once


def test_registered_queries_match_oracle(spark):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    sqls = entry.oracle_sql()
    bad = []
    for name, q in entry.queries().items():
        df = q(spark, SF_SMALL)
        rows = [tuple(r) for r in df.collect()]
        if name not in sqls:
            assert df.columns
            continue
        rel = con.sql(sqls[name])
        if sorted(df.columns) != sorted(rel.columns) or digest(df.columns, rows)[0] != digest(rel.columns, rel.fetchall())[0]:
            bad.append(name)
    assert bad == []


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 35 and "qufendu" in df.columns


def test_submit_command_line(spark):
    from itemstats.plans import submit

    base = tempfile.mkdtemp(prefix="itemstats-submit-")
    root = f"{base}/itemdata"
    tmp = tempfile.mkdtemp(prefix="itemstats-submit-src-")
    lines = fixture.as_json_lines(fixture.responses(spark, SF_SMALL)).filter("value like '%\"HOUSEHOLD\"%'")
    lines.select("value").coalesce(1).write.mode("overwrite").text(tmp)
    part = [f for f in os.listdir(tmp) if f.startswith("part-")][0]
    os.makedirs(f"{root}/HOUSEHOLD")
    for ts in ("20190227100000", "20190227120000"):
        shutil.copy(f"{tmp}/{part}", f"{root}/HOUSEHOLD/data.{ts}")
    fixture.wide_paper_item(spark, SF_SMALL).coalesce(1).write.json(f"{root}_p")
    fixture.item_knowledge(spark, SF_SMALL).coalesce(1).write.json(f"{root}_k")
    out = f"{base}/out"
    res = submit.main([root, "HOUSEHOLD", "20190227110000", "12", out])
    assert set(res) == {"t_score_total", "t_item_index", "t_paper_index", "t_item_fpg"}
    got = results.read_result(spark, f"{out}/t_item_index")
    assert got.count() == 7 and {(r.paper_code, r.create_time) for r in got.collect()} == {("HOUSEHOLD", "20190227110000")}


def test_pipeline_parity_options(spark):
    opts = pipeline.Options(narrow=True, rounded=True, missing="zero")
    res = pipeline.analyse(fixture.responses(spark, SF_SMALL), fixture.blueprint(spark, SF_SMALL), steps="1", options=opts)
    types = dict(res["t_item_index"].dtypes)
    assert types["nandu"] == "decimal(4,3)" and types["fc_score"] == "decimal(4,3)"
    assert dict(res["t_paper_index"].dtypes)["fc_score"] == "decimal(7,3)"
    assert res["t_score_total"].filter("total_score is null").count() == 0      # zero mode
    assert res["t_paper_index"].count() == 5


def test_pipeline_into_tables(spark):
    db = "itemstats_pipe_db"
    results.ensure_tables(spark, db, tempfile.mkdtemp(prefix="itemstats-wh2-"))
    opts = pipeline.Options(knowledge_support=0.45, max_iter=3)
    args = (fixture.responses(spark, SF_SMALL), fixture.blueprint(spark, SF_SMALL), db, fixture.item_knowledge(spark, SF_SMALL))
    pipeline.run(*args, steps="123", options=opts, as_table=True)
    pipeline.run(*args, steps="123", options=opts, as_table=True)          # a re-run replaces, never appends
    counts = {t: spark.table(f"{db}.{t}").count() for t in results.DDL}
    assert counts["t_item_index"] == 35 and counts["t_paper_index"] == 5 and counts["t_score_total"] == 150
    assert counts["t_item_fpg"] > 0 and 0 < counts["t_item_cluster"] <= 150
    assert spark.table(f"{db}.t_item_index").filter("nandu < 0 or nandu > 1").count() == 0

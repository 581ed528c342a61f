from __future__ import annotations

import random

import pyarrow as pa
from pyspark.sql import functions as F

from itemstats.llm import common


def brute(edges):
    comp = {x: x for e in edges for x in e if e[0] != e[1]}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a != b and comp[a] != comp[b]:
                comp[a] = comp[b] = min(comp[a], comp[b])
                changed = True
    return comp


def test_components_against_brute_force(spark):
    rnd = random.Random(1)
    cases = [[], [(5, 5)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)] + [(100, 1)],
             [(rnd.randrange(-80, 80), rnd.randrange(-80, 80)) for _ in range(90)]]
    for edges in cases:
        df = spark.createDataFrame(edges, "a long, b long")
        rows = common.components(common.Scratch(spark, "test"), df).collect()
        assert len(rows) == len({r["node"] for r in rows})
        assert {r["node"]: r["component"] for r in rows} == brute(edges)


def test_join_keyed_splits_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(common, "HEAVY_KEYS", 10)
    big = spark.createDataFrame([(None if i % 7 == 0 else "hot" if i % 2 else f"k{i}", i) for i in range(200)], "key string, i long")
    keyed = big.filter("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("n"), F.min("i").alias("low"))
    got = {r["i"]: r["low"] for r in common.join_keyed(big, keyed, "key", "n", 200).collect()}
    assert len(got) == 200 and got[1] == 1 and got[199] == 1 and got[0] is None and got[2] == 2


def test_ordered_keeps_one_order(spark):
    scratch = common.Scratch(spark, "test")
    df = spark.createDataFrame([(i % 3, i) for i in range(500)], "k long, i long")
    rows = common.ordered(scratch, df, ["k", "i"]).orderBy("part", "row").collect()
    assert [(r["k"], r["i"]) for r in rows] == sorted((i % 3, i) for i in range(500))


def test_texts_reach_workers_in_bounded_batches(spark):
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(limit, None)
    texts = spark.range(0, 4000, 1, 1).select(F.repeat(F.lit("x"), 10_000).alias("text"))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": [b.num_rows], "bytes": [b.nbytes]})

    try:
        spark.conf.unset(limit)
        got = common.map_in_arrow(texts, sizes, "rows long, bytes long").collect()
        assert sum(r["rows"] for r in got) == 4000
        assert max(r["bytes"] for r in got) < 2 * common.BATCH_BYTES
        spark.conf.set(limit, "1m")  # a session's own limit stays
        got = common.map_in_arrow(texts, sizes, "rows long, bytes long").collect()
        assert max(r["bytes"] for r in got) < 2 << 20 and spark.conf.get(limit) == "1m"
    finally:
        spark.conf.unset(limit) if before is None else spark.conf.set(limit, before)

"""Benchmark: headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints one JSON line.  Every query runs to completion through Spark's
``noop`` sink (no collect).  ``baseline`` times the reference's shape on the
same data, one Spark job per (paper, item) with the high / low groups
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from itemstats.functions.sizing import stored  # noqa: E402
from itemstats.plans import pipeline, queries  # noqa: E402
from itemstats.session import local_session  # noqa: E402
from itemstats.sources import fixture  # noqa: E402

HEADLINE = [
    "item_index",
    "paper_index",
    "high_low_groups",
    "responses_long",
    "knowledge_scores",
    "item_rules",
    "knowledge_rules",
    "cluster_profile_given",
    "student_clusters",
]


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return round(time.perf_counter() - t0, 3)


def full_pipeline(spark: SparkSession, sf_dir: str) -> None:
    res = pipeline.analyse(
        fixture.responses(spark, sf_dir),
        fixture.blueprint(spark, sf_dir),
        fixture.item_knowledge(spark, sf_dir),
        steps="123",
        options=pipeline.Options(knowledge_support=0.45, item_rules=True, item_support=0.3),
    )
    for df in res.values():
        drain(df)


def reference_shape(spark: SparkSession, sf_dir: str) -> None:
    """One job per (paper, item): totals sorted twice for the 27 % groups, then an
    aggregate with two scalar subqueries, as the reference's per-item SQL."""
    r = fixture.responses(spark, sf_dir)
    wide = r.groupBy("paper_code", "stu_code").pivot("item_id", list(range(1, fixture.N_ITEMS + 1))).agg(F.first("score"))
    # stored once, as the reference read one parsed file: its jobs do not pay for deriving the fixture
    wide = stored(wide.withColumn("total_score", sum(F.col(str(i)) for i in range(1, fixture.N_ITEMS + 1))))
    marks = {}
    first = 1
    for _, kind, qty, mark in fixture.LAYOUT:
        for i in range(first, first + qty):
            marks[i] = (kind, mark)
        first += qty
    for row in fixture.papers(spark, sf_dir).collect():
        p = row["paper_code"]
        t = wide.filter(F.col("paper_code") == p)
        n = t.count()
        pg = int(n * 0.27 + 0.5)
        hi = t.orderBy(F.col("total_score").desc()).limit(pg)
        lo = t.orderBy(F.col("total_score").asc()).limit(pg)
        for i, (kind, mark) in marks.items():
            c = F.col(str(i))
            s_hi = hi.agg(F.sum(c)).first()[0] or 0
            s_lo = lo.agg(F.sum(c)).first()[0] or 0
            t.agg(F.max(c), F.min(c), F.avg(c), F.var_pop(c), F.stddev_pop(c), F.sum(c)).first()
            _ = (s_hi - s_lo) / max(pg, 1) / mark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="itemstats-bench")
    reg = queries.registry()
    # warm the JVM (class loading, JIT, code generation) on the smallest tables, so the timings below
    # are steady-state throughput; the yardstick is warmed the same way
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm) and os.path.abspath(warm) != os.path.abspath(sf_dir):
        for name in HEADLINE:
            drain(reg[name](spark, warm))
        reference_shape(spark, warm)
    times = {}
    for name in HEADLINE:
        times[name] = timed(lambda: drain(reg[name](spark, sf_dir)))
    times["pipeline_all_steps"] = timed(lambda: full_pipeline(spark, sf_dir))
    baseline = timed(lambda: reference_shape(spark, sf_dir))
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                "baseline_reference_shape_item_index_sec": baseline,
                "item_index_speedup_vs_reference_shape": round(baseline / max(times["item_index"], 1e-9), 2),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

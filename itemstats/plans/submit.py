"""Command line in the reference's shape, for ``spark-submit``.

    spark-submit -m itemstats.plans.submit <input_dir> <paper_code> <submit_time> <steps> <target>
        [--blueprint PATH_OR_TABLE] [--knowledge PATH_OR_TABLE] [--jdbc-url URL --jdbc-user U --jdbc-password P]
        [--tables] [--export]

``<input_dir>/<paper_code>/data.<ts>`` holds the answer batches; the first batch
not older than ``submit_time`` is analysed (or the latest one) and the results
are keyed by ``submit_time``.  Blueprint and knowledge map come from JSON files
(default ``<input_dir>_p`` / ``<input_dir>_k``) or, with ``--jdbc-url``, from
database tables (default ``t_paper_item`` / ``t_item_knowledge``).  ``steps`` is
any combination of ``1`` (statistics), ``2`` (rules), ``3`` (clusters).
Results go to ``<target>/<table>`` as Parquet, or to tables ``<target>.<table>``
with ``--tables``; ``--export`` appends them to the database of ``--jdbc-url`` too.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from itemstats.plans import pipeline
from itemstats.sources import batches, tables


def main(argv: list[str] | None = None) -> dict:
    p = argparse.ArgumentParser(prog="itemstats")
    p.add_argument("input_dir")
    p.add_argument("paper_code")
    p.add_argument("submit_time")
    p.add_argument("steps")
    p.add_argument("target")
    p.add_argument("--blueprint")
    p.add_argument("--knowledge")
    p.add_argument("--jdbc-url")
    p.add_argument("--jdbc-user")
    p.add_argument("--jdbc-password")
    p.add_argument("--tables", action="store_true")
    p.add_argument("--export", action="store_true")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("itemstats").getOrCreate()

    jdbc = {}
    if a.jdbc_url:
        jdbc = {"url": a.jdbc_url}
        if a.jdbc_user:
            jdbc["user"] = a.jdbc_user
        if a.jdbc_password:
            jdbc["password"] = a.jdbc_password
    root = a.input_dir.rstrip("/")
    bp_src = a.blueprint or ("t_paper_item" if jdbc else f"{root}_p")
    ik_src = a.knowledge or ("t_item_knowledge" if jdbc else f"{root}_k")
    paper = F.lit(a.paper_code)
    bp = tables.read_blueprint(spark, bp_src, **jdbc).where(F.col("paper_code") == paper)
    ik = None
    if "2" in a.steps:
        ik = tables.read_item_knowledge(spark, ik_src, **jdbc).where(F.col("paper_code") == paper)
    req = spark.createDataFrame([(a.paper_code, a.submit_time)], "paper_code string, submit_time string")
    # list and read only this paper's folder
    sheets = batches.read_requested(spark, f"{root}/{a.paper_code}", req, as_sheets=True)
    return pipeline.run(None, bp, a.target, ik, a.steps, as_table=a.tables, sheets=sheets, jdbc=jdbc if a.export else None)


if __name__ == "__main__":
    main()

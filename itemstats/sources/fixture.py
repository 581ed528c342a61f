"""Exam data derived from the driver's TPC-H-like tables (test and bench input).

Papers are customer market segments, students are customers, items are
line numbers 1..7 and a score is derived from the customer's ordered
quantities.  The same rows come out of the SQL in ``ORACLE_RESPONSES``
(DuckDB and Spark SQL alike), which the oracle queries build on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemstats.schema import OBJECTIVE, SUBJECTIVE

CREATE_TIME = "1551231000"

# Fixed values of the fixture: the layout of every paper, as
# (section, kind, items in the section, full mark of each item).
LAYOUT = [
    (1, OBJECTIVE, 3, 2),
    (2, SUBJECTIVE, 2, 5),
    (3, SUBJECTIVE, 2, 12),
]
# Fixed values of the fixture: item -> knowledge point pairs (kl_id, item_id),
# the same for every paper; ids 9 and 12 order differently as strings and ints.
KNOWLEDGE = [(1, 1), (1, 4), (2, 2), (2, 5), (2, 6), (3, 3), (3, 7), (9, 1), (9, 2), (9, 3), (12, 6), (12, 7)]
N_ITEMS = sum(q for _, _, q, _ in LAYOUT)
MAX_TOTAL = sum(q * m for _, _, q, m in LAYOUT)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long responses: one row per (paper, batch, student, item) with a score."""
    li = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = _table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    cell = (
        li.join(orders, li.l_orderkey == orders.o_orderkey)
        .groupBy(F.col("o_custkey").alias("ck"), F.col("l_linenumber").alias("item_id"))
        .agg(F.sum("l_quantity").cast("bigint").alias("q"))
    )
    z = ((F.col("c_custkey") * 7919) % 101) * 3 + F.col("q") % 101
    raw = cell.join(cust, cust.c_custkey == cell.ck).select(
        F.col("c_mktsegment").alias("paper_code"), "ck", "item_id", z.alias("z")
    )
    item = F.col("item_id")
    score = (
        F.when(item <= 3, F.when(F.col("z") + item * 25 >= 200, 2).otherwise(0))
        .when(item <= 5, F.least(F.lit(5), F.floor(5 * F.col("z") / 400.0).cast("int")))
        .otherwise(F.least(F.lit(12), F.floor(12 * F.col("z") / 400.0).cast("int")))
    )
    return raw.select(
        "paper_code",
        F.lit(CREATE_TIME).alias("create_time"),
        F.lpad(F.col("ck").cast("string"), F.greatest(F.lit(8), F.length(F.col("ck").cast("string"))), F.lit("0")).alias("stu_code"),
        F.lit(1).alias("attempt"),
        F.when(item <= 3, 1).when(item <= 5, 2).otherwise(3).alias("section"),
        item.alias("item_id"),
        score.cast("int").alias("score"),
    )


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paper codes present in the data (one per market segment)."""
    return _table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("paper_code")).distinct()


def blueprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``blueprint(paper_code, section, kind, qty, full_mark)`` for every paper of the data."""
    rows = [
        F.struct(F.lit(s).alias("section"), F.lit(k).alias("kind"), F.lit(q).alias("qty"), F.lit(m).alias("full_mark"))
        for s, k, q, m in LAYOUT
    ]
    return papers(spark, sf_dir).select("paper_code", F.inline(F.array(*rows)))


def item_knowledge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``item_knowledge(paper_code, kl_id, item_id)`` for every paper of the data."""
    rows = [F.struct(F.lit(k).alias("kl_id"), F.lit(i).alias("item_id")) for k, i in KNOWLEDGE]
    return papers(spark, sf_dir).select("paper_code", F.inline(F.array(*rows)))


# --- the same fixture in SQL, for the DuckDB oracle -------------------------

ORACLE_RESPONSES = f"""
responses AS (
  WITH cell AS (
    SELECT o.o_custkey AS ck, l.l_linenumber AS item_id, CAST(SUM(l.l_quantity) AS BIGINT) AS q
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    GROUP BY o.o_custkey, l.l_linenumber),
  raw AS (
    SELECT c.c_mktsegment AS paper_code, c.c_custkey AS ck, cell.item_id,
           ((c.c_custkey * 7919) % 101) * 3 + cell.q % 101 AS z
    FROM cell JOIN customer c ON c.c_custkey = cell.ck)
  SELECT paper_code, '{CREATE_TIME}' AS create_time,
    LPAD(CAST(ck AS VARCHAR), CAST(GREATEST(8, LENGTH(CAST(ck AS VARCHAR))) AS INT), '0') AS stu_code,
    1 AS attempt,
    CASE WHEN item_id <= 3 THEN 1 WHEN item_id <= 5 THEN 2 ELSE 3 END AS section,
    item_id,
    CAST(CASE WHEN item_id <= 3 THEN CASE WHEN z + item_id * 25 >= 200 THEN 2 ELSE 0 END
         WHEN item_id <= 5 THEN LEAST(5, CAST(FLOOR(5 * z / 400.0) AS INT))
         ELSE LEAST(12, CAST(FLOOR(12 * z / 400.0) AS INT)) END AS INT) AS score
  FROM raw)"""

_layout_rows = ", ".join(f"({s}, '{k}', {q}, {m})" for s, k, q, m in LAYOUT)
_knowledge_rows = ", ".join(f"({k}, {i})" for k, i in KNOWLEDGE)

ORACLE_BLUEPRINT = f"""
papers AS (SELECT DISTINCT c_mktsegment AS paper_code FROM customer),
layout AS (SELECT * FROM (VALUES {_layout_rows}) AS v(section, kind, qty, full_mark)),
blueprint AS (SELECT p.paper_code, CAST(l.section AS INT) AS section, l.kind,
                     CAST(l.qty AS INT) AS qty, CAST(l.full_mark AS INT) AS full_mark
              FROM papers p CROSS JOIN layout l),
items AS (
  SELECT b.paper_code, b.section, b.kind, CAST(b.first_item + g.i AS INT) AS item_id, b.full_mark
  FROM (SELECT *, COALESCE(SUM(qty) OVER (PARTITION BY paper_code ORDER BY section
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 AS first_item
        FROM blueprint) b
  JOIN (SELECT * FROM (VALUES (0), (1), (2), (3), (4), (5), (6), (7), (8), (9)) AS t(i)) g ON g.i < b.qty)"""

ORACLE_KNOWLEDGE = f"""
kpairs AS (SELECT * FROM (VALUES {_knowledge_rows}) AS v(kl_id, item_id)),
item_knowledge AS (SELECT p.paper_code, CAST(k.kl_id AS INT) AS kl_id, CAST(k.item_id AS INT) AS item_id
                   FROM papers p CROSS JOIN kpairs k)"""


def oracle(body: str, *ctes: str, knowledge: bool = False, recursive: bool = False) -> str:
    """Prefix an oracle query with the fixture's common table expressions and ``ctes``."""
    parts = [ORACLE_RESPONSES, ORACLE_BLUEPRINT]
    if knowledge:
        parts.append(ORACLE_KNOWLEDGE)
    parts.extend(ctes)
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",".join(parts) + "\n" + body


def as_json_lines(responses: DataFrame) -> DataFrame:
    """The reference's input format, one JSON line per sample (``value``), built from long responses:
    ``{"stuCode":..,"paperCode":..,"item1":{"i1":2,..},..}``."""
    keys = ["paper_code", "create_time", "stu_code", "attempt"]
    sections = responses.groupBy(*keys, "section").agg(
        F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("i"), F.col("item_id").cast("string")), "score"))).alias("m")
    )
    sheets = sections.groupBy(*keys).agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("item"), F.col("section").cast("string")), "m")))).alias("j")
    )
    head = F.to_json(F.struct(F.col("stu_code").alias("stuCode"), F.col("paper_code").alias("paperCode")))
    sheets = sheets.withColumn("h", head)
    value = F.concat(F.col("h").substr(F.lit(1), F.length("h") - 1), F.lit(","), F.col("j").substr(F.lit(2), F.length("j")))
    return sheets.select("create_time", value.alias("value"))


def wide_paper_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's wide ``t_paper_item`` rows for every paper of the data."""
    cols = [F.lit(len(LAYOUT)).alias("all_items"),
            F.lit(sum(1 for _, k, _, _ in LAYOUT if k == OBJECTIVE)).alias("o_items"),
            F.lit(sum(1 for _, k, _, _ in LAYOUT if k == SUBJECTIVE)).alias("s_items")]
    cols += [F.lit(q).alias(f"part{s}_qty") for s, _, q, _ in LAYOUT]
    cols += [F.lit(m).alias(f"part{s}_mark") for s, _, _, m in LAYOUT]
    return papers(spark, sf_dir).select("paper_code", *cols)


def batch_requests(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Batch files and requests derived from orders: a finished order is a landed file
    ``data.<orderkey>`` of its customer's paper, any other order a request at that key."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    cust = _table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    j = orders.join(cust, orders.o_custkey == cust.c_custkey).select(
        F.col("c_mktsegment").alias("paper_code"),
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("key"),
        "o_orderstatus",
    )
    files = j.filter(F.col("o_orderstatus") == "F").select(
        "paper_code", F.col("key").alias("ts"),
        F.concat(F.lit("/landing/"), F.col("paper_code"), F.lit("/data."), F.col("key")).alias("path"),
    )
    requests = j.filter(F.col("o_orderstatus") != "F").select("paper_code", F.col("key").alias("submit_time"))
    return files, requests


ORACLE_BATCHES = """
ordp AS (SELECT c.c_mktsegment AS paper_code, LPAD(CAST(o.o_orderkey AS VARCHAR), 12, '0') AS k, o.o_orderstatus AS st
         FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
files AS (SELECT paper_code, k AS ts FROM ordp WHERE st = 'F'),
requests AS (SELECT paper_code, k AS submit_time FROM ordp WHERE st <> 'F')"""

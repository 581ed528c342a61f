"""Paper blueprints and item -> knowledge maps.

The reference keeps one wide row per paper (``t_paper_item``: ``paper_code``,
``all_items``, ``o_items``, ``s_items``, ``part<k>_qty``, ``part<k>_mark``) and
a map table (``t_item_knowledge``: ``ik_id``, ``paper_code``, ``kl_id``,
``item_id``), in MySQL or as JSON files.  Both become long DataFrames here.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemstats.schema import OBJECTIVE, SUBJECTIVE

_PART = re.compile(r"^part(\d+)_(qty|mark)$")


def wide_blueprint(paper_item: DataFrame) -> DataFrame:
    """Unpivot the wide ``t_paper_item`` rows to ``blueprint(paper_code, section, kind, qty, full_mark)``.

    Section ``k`` exists when ``k <= all_items``; the first ``o_items`` sections are
    objective, the rest subjective.  Works for any number of sections and for
    papers without objective or without subjective sections (D5).
    """
    parts = sorted({int(m.group(1)) for c in paper_item.columns if (m := _PART.match(c))})
    if not parts:
        raise ValueError("no part<k>_qty / part<k>_mark columns")
    cols = set(paper_item.columns)
    rows = [
        F.struct(
            F.lit(k).alias("section"),
            (F.col(f"part{k}_qty") if f"part{k}_qty" in cols else F.lit(None)).cast("int").alias("qty"),
            (F.col(f"part{k}_mark") if f"part{k}_mark" in cols else F.lit(None)).cast("int").alias("full_mark"),
        )
        for k in parts
    ]
    long = paper_item.select(
        F.col("paper_code").cast("string").alias("paper_code"),
        F.col("all_items").cast("int").alias("_all"),
        F.coalesce(F.col("o_items").cast("int"), F.lit(0)).alias("_obj"),
        F.inline(F.array(*rows)),
    )
    return long.filter((F.col("section") <= F.col("_all")) & F.col("qty").isNotNull()).select(
        "paper_code",
        "section",
        F.when(F.col("section") <= F.col("_obj"), F.lit(OBJECTIVE)).otherwise(F.lit(SUBJECTIVE)).alias("kind"),
        "qty",
        "full_mark",
    )


def read_blueprint(spark: SparkSession, source: DataFrame | str, **jdbc: str) -> DataFrame:
    """Blueprint from a DataFrame, a JSON path (``<input>_p``) or a JDBC table.

    ``read_blueprint(spark, "t_paper_item", url=..., user=..., password=...)`` reads
    over JDBC; filters applied later (``paper_code = ...``) are pushed to the database.
    Pass ``partitionColumn`` / ``lowerBound`` / ``upperBound`` / ``numPartitions`` for a
    parallel read of a large table.
    """
    return wide_blueprint(_load(spark, source, jdbc))


def read_item_knowledge(spark: SparkSession, source: DataFrame | str, **jdbc: str) -> DataFrame:
    """``item_knowledge(paper_code, kl_id, item_id)`` from a DataFrame, JSON path or JDBC table."""
    df = _load(spark, source, jdbc)
    return df.select(
        F.col("paper_code").cast("string").alias("paper_code"),
        F.col("kl_id").cast("int").alias("kl_id"),
        F.col("item_id").cast("int").alias("item_id"),
    ).dropDuplicates()


def _load(spark: SparkSession, source: DataFrame | str, jdbc: dict[str, str]) -> DataFrame:
    if isinstance(source, DataFrame):
        return source
    if jdbc:
        return spark.read.format("jdbc").option("dbtable", source).options(**jdbc).load()
    return spark.read.json(source)

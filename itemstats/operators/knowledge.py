"""Knowledge points: full marks, per-student scores and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemstats.functions.labels import knowledge_label, tag
from itemstats.functions.sizing import small_side
from itemstats.operators.reshape import cell, score_type
from itemstats.schema import STUDENT_KEYS


def full_marks(item_knowledge: DataFrame, items: DataFrame) -> DataFrame:
    """Per (paper, knowledge point): its blueprint items and theoretical full mark.

    ``(paper_code, kl_id, kl_items array<int> ascending, full_mark)``; the full
    mark is the sum of the marks of the point's distinct items.  Items outside
    the blueprint are left out (the reference only counted items inside a
    section's range).
    """
    marks = items.select("paper_code", "item_id", "full_mark")
    j = item_knowledge.select("paper_code", "kl_id", "item_id").dropDuplicates().join(marks, ["paper_code", "item_id"])
    return j.groupBy("paper_code", "kl_id").agg(
        F.array_sort(F.collect_list("item_id")).alias("kl_items"),
        F.sum("full_mark").cast("int").alias("full_mark"),
    )


def points_by_paper(item_knowledge: DataFrame, items: DataFrame) -> DataFrame:
    """Per paper, its knowledge points as an array of ``(kl_id, kl_items, full_mark)`` ascending by id."""
    return small_side(
        full_marks(item_knowledge, items).groupBy("paper_code").agg(
            F.array_sort(F.collect_list(F.struct("kl_id", "kl_items", "full_mark"))).alias("_points")
        )
    )


def _point_score(cells: F.Column, kl_items: F.Column, missing: str, kind: str) -> F.Column:
    vals = F.transform(kl_items, lambda i: cell(cells, i))
    if missing == "zero":
        vals = F.transform(vals, lambda x: F.coalesce(x, F.lit(0).cast(kind)))
    return F.aggregate(vals, F.lit(0).cast(kind), lambda acc, x: (acc + x).cast(kind))


def transactions(sheets: DataFrame, item_knowledge: DataFrame, items: DataFrame, missing: str = "propagate") -> DataFrame:
    """One transaction per sample: sorted tags ``<kl_id>h`` / ``<kl_id>l`` of its paper's points.

    Built on the sheet itself; a point whose score is null has no label and is
    left out of the transaction (the reference failed on it, D4).
    """
    s = sheets.join(points_by_paper(item_knowledge, items), "paper_code")
    tags = F.transform(
        "_points",
        lambda p: tag(p["kl_id"], knowledge_label(_point_score(F.col("cells"), p["kl_items"], missing, score_type(sheets)), p["full_mark"])),
    )
    return s.select(*STUDENT_KEYS, F.array_sort(F.filter(tags, lambda x: x.isNotNull())).alias("items"))


def scores(sheets: DataFrame, item_knowledge: DataFrame, items: DataFrame, missing: str = "propagate") -> DataFrame:
    """Score of every sample on every knowledge point of its paper.

    ``(paper_code, create_time, stu_code, attempt, kl_id, kl_score, full_mark)``;
    ``kl_score`` is the sum of the point's item scores, null when one of them is
    missing (``missing="propagate"``) or counting it 0 (``"zero"``).  One row per
    sheet and point, straight from the sheet: no regrouping of responses.
    """
    s = sheets.join(points_by_paper(item_knowledge, items), "paper_code")
    p = s.select(*STUDENT_KEYS, "cells", F.explode("_points").alias("_p"))
    return p.select(
        *STUDENT_KEYS,
        F.col("_p.kl_id").alias("kl_id"),
        _point_score(F.col("cells"), F.col("_p.kl_items"), missing, score_type(sheets)).alias("kl_score"),
        F.col("_p.full_mark").alias("full_mark"),
    )


def labels(kscores: DataFrame) -> DataFrame:
    """Add ``label`` (``h`` / ``l`` / null) and ``tag`` (e.g. ``12h``) to knowledge scores."""
    lab = knowledge_label(F.col("kl_score"), F.col("full_mark"))
    return kscores.withColumn("label", lab).withColumn("tag", tag(F.col("kl_id"), F.col("label")))

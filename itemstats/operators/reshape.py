"""Reshaping: blueprint -> items, long responses -> one answer sheet per sample.

The answer sheet (``sheets``) is the central intermediate: the long
responses are shuffled once by student and every later result (totals,
groups, item statistics, labels, knowledge scores, clusters) reads it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from itemstats.functions.sizing import checked, small_side
from itemstats.schema import BATCH_KEYS, STUDENT_KEYS


def blueprint_items(blueprint: DataFrame) -> DataFrame:
    """Expand ``blueprint(paper_code, section, kind, qty, full_mark)`` to one row per item.

    Items are numbered across the whole paper in section order: the first item
    of a section follows the running count of the sections before it.
    Returns ``items(paper_code, section, kind, item_id, full_mark)``.
    """
    before = Window.partitionBy("paper_code").orderBy("section").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("qty").over(before), F.lit(0)).cast("int") + 1
    bp = blueprint.withColumn("first_item", first)
    ids = F.when(
        F.col("qty") > 0, F.sequence(F.col("first_item"), F.col("first_item") + F.col("qty") - 1)
    ).otherwise(F.array().cast("array<int>"))
    bp = bp.withColumn("_ids", ids)
    return bp.select(
        "paper_code",
        F.col("section").cast("int").alias("section"),
        "kind",
        F.col("full_mark").cast("int").alias("full_mark"),
        F.explode("_ids").alias("item_id"),
    ).select("paper_code", "section", "kind", F.col("item_id").cast("int").alias("item_id"), "full_mark")


def paper_items(items: DataFrame) -> DataFrame:
    """One row per paper: ``(paper_code, item_ids array<int> ascending, n_items)``."""
    return items.groupBy("paper_code").agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"),
        F.countDistinct("item_id").cast("int").alias("n_items"),
    )


def attach_marks(responses: DataFrame, items: DataFrame) -> DataFrame:
    """Responses with the item's ``kind`` and ``full_mark`` (equi join on paper and item;
    the item table is broadcast after a size check, so responses are not shuffled by item)."""
    marks = small_side(items.select("paper_code", "item_id", "kind", "full_mark"))
    return responses.join(marks, ["paper_code", "item_id"])


def latest_attempt(df: DataFrame) -> DataFrame:
    """Keep only each student's last attempt in a batch (D22 ``dedupe="last"``), for
    responses or sheets; by default every attempt is a sample, as in the reference.

    The students with more than one attempt (normally few) are found by an
    aggregation and broadcast after a size check; no window over a student."""
    student = [*BATCH_KEYS, "stu_code"]
    last, n = checked(df.groupBy(*student).agg(F.max("attempt").alias("_last")).filter(F.col("_last") > 1))
    if n == 0:
        return df
    j = df.join(last, student, "left")
    return j.filter(F.col("_last").isNull() | (F.col("attempt") == F.col("_last"))).drop("_last")


def answer_sheets(responses: DataFrame) -> DataFrame:
    """Gather the long responses into one row per sample.

    ``sheets(paper_code, create_time, stu_code, attempt, cells map<int,int>)``;
    the only shuffle of the long table.
    """
    return responses.groupBy(*STUDENT_KEYS).agg(
        unique_cells(F.collect_list(F.struct("item_id", "score"))).alias("cells")
    )


def unique_cells(entries: Column) -> Column:
    """``array<struct<item_id, score>>`` -> ``map<item_id, score>``; an item given twice on one
    sheet keeps one value (the lower score; a score before a null) instead of failing the job."""
    # each entry is compared with the previous item id; the arrays are built once per row
    # (a lambda that referred back to the sorted array would re-sort it for every element)
    flagged = F.transform(entries, lambda e: F.struct(e["item_id"].alias("item_id"), e["score"].isNull().alias("_none"), e["score"].alias("score")))
    ordered = F.transform(F.array_sort(flagged), lambda e: F.struct(e["item_id"].alias("item_id"), e["score"].alias("score")))
    ids = F.transform(ordered, lambda e: e["item_id"])
    prev = F.concat(F.array(F.lit(None).cast("int")), F.slice(ids, 1, F.greatest(F.size(ids) - 1, F.lit(0))))
    firsts = F.zip_with(ordered, prev, lambda e, p: F.when(p.isNull() | (e["item_id"] != p), e))
    return F.map_from_entries(F.filter(firsts, lambda x: x.isNotNull()))


def with_papers(sheets: DataFrame, items: DataFrame) -> DataFrame:
    """Attach each sheet's paper item list (``item_ids``, ``n_items``); papers absent from
    the blueprint are dropped.  The paper side (one row per paper) is broadcast
    after a size check, so the sheets are never shuffled by paper, a hot key."""
    return sheets.join(small_side(paper_items(items)), "paper_code")


def cell(cells: Column, item_id: Column) -> Column:
    """Score of one item on a sheet; null when the cell is missing."""
    return F.try_element_at(cells, item_id)


def score_type(sheets: DataFrame) -> str:
    """Type of the scores on the sheets: ``int``, or ``double`` where marks may be fractional."""
    return sheets.schema["cells"].dataType.valueType.simpleString()


def complete(sheets: DataFrame, items: DataFrame) -> DataFrame:
    """Every (sample, blueprint item) with its score, null where the sheet has no cell.

    Mirrors the wide reference row, where every item of the paper is a column.
    """
    s = with_papers(sheets, items)
    return s.select(*STUDENT_KEYS, F.explode("item_ids").alias("item_id"), "cells").select(
        *STUDENT_KEYS, "item_id", cell(F.col("cells"), F.col("item_id")).alias("score")
    )


def batches(sheets: DataFrame) -> DataFrame:
    """Distinct batch keys of the data."""
    return sheets.select(*BATCH_KEYS).distinct()

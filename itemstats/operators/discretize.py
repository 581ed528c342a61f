"""Right / wrong labels per item and the transactions the rule miner reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemstats.defaults import EXTREME_HI, EXTREME_LO
from itemstats.functions.labels import item_label, tag
from itemstats.functions.sizing import small_side
from itemstats.operators.reshape import cell
from itemstats.schema import BATCH_KEYS, STUDENT_KEYS


def _item_meta(items: DataFrame) -> DataFrame:
    """Per paper, its items as an ascending array of ``(item_id, kind, full_mark)``."""
    return small_side(
        items.groupBy("paper_code").agg(
            F.array_sort(F.collect_list(F.struct("item_id", "kind", "full_mark"))).alias("_items")
        )
    )


def item_labels(sheets: DataFrame, items: DataFrame) -> DataFrame:
    """One row per (sample, blueprint item): ``score``, ``label`` (``t``/``f``) and ``tag`` (``3t``)."""
    s = sheets.join(_item_meta(items), "paper_code")
    long = s.select(*STUDENT_KEYS, "cells", F.explode("_items").alias("_it")).select(
        *STUDENT_KEYS,
        F.col("_it.item_id").alias("item_id"),
        cell(F.col("cells"), F.col("_it.item_id")).alias("score"),
        F.col("_it.kind").alias("kind"),
        F.col("_it.full_mark").alias("full_mark"),
    )
    lab = item_label(F.col("score"), F.col("kind"), F.col("full_mark"))
    return long.select(*STUDENT_KEYS, "item_id", "score", lab.alias("label"), tag(F.col("item_id"), lab).alias("tag"))


def extreme_items(item_index: DataFrame, lo: float = EXTREME_LO, hi: float = EXTREME_HI) -> DataFrame:
    """Items too hard or too easy for rule mining: ``nandu < lo`` or ``nandu > hi`` (bounds kept)."""
    n = F.col("nandu")
    return item_index.filter((n > hi) | (n < lo)).select(*BATCH_KEYS, "item_id", "nandu")


def kept_items(item_index: DataFrame, lo: float = EXTREME_LO, hi: float = EXTREME_HI) -> DataFrame:
    """The complement of :func:`extreme_items` among a batch's items (anti join)."""
    return item_index.select(*BATCH_KEYS, "item_id").join(
        extreme_items(item_index, lo, hi), [*BATCH_KEYS, "item_id"], "left_anti"
    )


def item_transactions(sheets: DataFrame, items: DataFrame, drop: DataFrame | None = None) -> DataFrame:
    """One transaction per sample: the sorted tags of the paper's items (``["1t","2f",...]``).

    Built on the sheet itself (no regrouping); ``drop(paper_code, create_time,
    item_id)`` lists items to leave out, e.g. :func:`extreme_items`.
    """
    s = sheets.join(_item_meta(items), "paper_code")
    if drop is not None:
        bad = small_side(drop.groupBy(*BATCH_KEYS).agg(F.collect_set("item_id").alias("_drop")))
        s = s.join(bad, BATCH_KEYS, "left")
        keep = F.filter("_items", lambda it: ~F.coalesce(F.array_contains(F.col("_drop"), it["item_id"]), F.lit(False)))
    else:
        keep = F.col("_items")
    tags = F.transform(
        keep,
        lambda it: tag(it["item_id"], item_label(cell(F.col("cells"), it["item_id"]), it["kind"], it["full_mark"])),
    )
    return s.select(*STUDENT_KEYS, F.array_sort(tags).alias("items"))

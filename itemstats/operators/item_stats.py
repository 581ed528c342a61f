"""Per-item statistics of a batch (A3-A9): the ``t_item_index`` result.

One ``groupBy(batch, item)`` for all items, papers and batches; the
reference ran one SQL job per item, each re-sorting the high / low groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemstats.defaults import GROUP_FRACTION
from itemstats.operators.reshape import cell
from itemstats.operators.totals import high_low_groups, total_score
from itemstats.schema import BATCH_KEYS, ITEM_INDEX_COLUMNS, OBJECTIVE


def from_groups(grouped: DataFrame, items: DataFrame) -> DataFrame:
    """Item statistics from sheets carrying ``cells``, ``item_ids``, ``is_high``, ``is_low``, ``n``, ``pg``.

    * every item of the blueprint has a row, also one nobody answered (null statistics);
    * max / min / avg / var_pop / stddev_pop skip missing cells (``missing="zero"`` has none:
      :func:`itemstats.operators.totals.total_score` fills them with 0);
    * ``nandu`` (difficulty) = sum / full mark / n, so a missing cell counts 0;
    * ``qufendu`` (discrimination) = (sum over high group - sum over low group) / pg
      divided by the full mark for an objective item, by (max - min) for a
      subjective one; null when a divisor is 0 or a group has no score of the item.
    """
    cells = grouped.select(
        *BATCH_KEYS, "n", "pg", "is_high", "is_low", "cells", F.explode("item_ids").alias("item_id")
    ).withColumn("score", cell(F.col("cells"), F.col("item_id")))
    score = F.col("score")
    agg = cells.groupBy(*BATCH_KEYS, "item_id").agg(
        F.max(score).alias("max_score"),
        F.min(score).alias("min_score"),
        F.avg(score).alias("avg_score"),
        F.var_pop(score).alias("fc_score"),
        F.stddev_pop(score).alias("bzc_score"),
        F.sum(score).alias("_sum"),
        F.sum(F.when(F.col("is_high"), score)).alias("_sum_hi"),
        F.sum(F.when(F.col("is_low"), score)).alias("_sum_lo"),
        F.max("n").alias("_n"),
        F.max("pg").alias("_pg"),
    )
    return from_sums(agg, items)


def from_sums(agg: DataFrame, items: DataFrame) -> DataFrame:
    """Difficulty and discrimination from each item's sums: over all samples (``_sum``), the high and the
    low group (``_sum_hi``, ``_sum_lo``), with the batch's ``_n`` samples and group size ``_pg``."""
    marks = items.select("paper_code", "item_id", "kind", "full_mark")
    j = agg.join(marks, ["paper_code", "item_id"])
    full = F.col("full_mark").cast("double")
    nandu = F.try_divide(F.try_divide(F.col("_sum").cast("double"), full), F.col("_n").cast("double"))
    spread = F.when(F.col("kind") == OBJECTIVE, full).otherwise(
        (F.col("max_score") - F.col("min_score")).cast("double")
    )
    diff = (F.col("_sum_hi") - F.col("_sum_lo")).cast("double")
    qufendu = F.try_divide(F.try_divide(diff, F.col("_pg").cast("double")), spread)
    return j.select(
        *BATCH_KEYS,
        "item_id",
        "max_score",
        "min_score",
        "avg_score",
        "fc_score",
        "bzc_score",
        nandu.alias("nandu"),
        qufendu.alias("qufendu"),
    )


def compute(
    sheets: DataFrame, items: DataFrame, missing: str = "propagate", fraction: float = GROUP_FRACTION
) -> DataFrame:
    """``t_item_index`` from answer sheets and blueprint items (totals and groups included)."""
    grouped = high_low_groups(total_score(sheets, items, missing), fraction)
    return from_groups(grouped, items).select(*ITEM_INDEX_COLUMNS)

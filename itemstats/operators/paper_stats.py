"""Per-paper statistics of a batch (A10-A12): the ``t_paper_index`` result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemstats.operators.reshape import paper_items
from itemstats.schema import BATCH_KEYS, PAPER_INDEX_COLUMNS


def cronbach_alpha(k: F.Column, sum_item_var: F.Column, total_var: F.Column) -> F.Column:
    """``k / (k - 1) * (1 - sum of item variances / variance of totals)``; null for k = 1
    or a zero total variance."""
    k = k.cast("double")
    return F.try_divide(k, k - 1) * (F.lit(1.0) - F.try_divide(sum_item_var, total_var))


def compute(totals: DataFrame, item_index: DataFrame, items: DataFrame, rounded: bool = False) -> DataFrame:
    """Paper statistics from the score totals and the item statistics of each batch.

    max / min / mean / var_pop / stddev_pop of the totals (null totals skipped),
    the unweighted mean of the items' ``nandu`` and ``qufendu``, and Cronbach's
    alpha over the ``k`` items of the blueprint.  ``rounded=True`` first rounds the
    item values to 3 decimals, as the reference read them back from its
    decimal(4,3) table (D8).
    """
    t = F.col("total_score")
    paper = totals.groupBy(*BATCH_KEYS).agg(
        F.max(t).alias("max_score"),
        F.min(t).alias("min_score"),
        F.avg(t).alias("avg_score"),
        F.var_pop(t).alias("fc_score"),
        F.stddev_pop(t).alias("bzc_score"),
    )
    return from_totals(paper, item_index, items, rounded)


def from_totals(paper: DataFrame, item_index: DataFrame, items: DataFrame, rounded: bool = False) -> DataFrame:
    """The same from each batch's statistics of the totals (``paper``)."""

    def item_value(name: str) -> F.Column:
        c = F.col(name)
        return F.round(c, 3) if rounded else c

    per_item = item_index.groupBy(*BATCH_KEYS).agg(
        F.avg(item_value("nandu")).alias("nandu"),
        F.avg(item_value("qufendu")).alias("qufendu"),
        F.sum(item_value("fc_score")).alias("_sum_var"),
    )
    k = paper_items(items).select("paper_code", "n_items")
    j = paper.join(per_item, BATCH_KEYS, "left").join(k, "paper_code", "left")
    return j.withColumn("xindu", cronbach_alpha(F.col("n_items"), F.col("_sum_var"), F.col("fc_score"))).select(
        *PAPER_INDEX_COLUMNS
    )

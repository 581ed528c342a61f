"""Column expressions that turn scores into right / wrong and high / low labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from itemstats.schema import OBJECTIVE

RIGHT, WRONG = "t", "f"
HIGH, LOW = "h", "l"


def item_label(score: Column, kind: Column, full_mark: Column) -> Column:
    """``t`` / ``f`` for one item.

    Objective: right when the score is above 0 (partial credit is right, D17).
    Subjective: right when the score is strictly above half the full mark (D18).
    A missing or null score is wrong.
    """
    right = F.when(kind == OBJECTIVE, score > 0).otherwise(score > full_mark.cast("double") / 2.0)
    return F.when(F.coalesce(right, F.lit(False)), F.lit(RIGHT)).otherwise(F.lit(WRONG))


def knowledge_label(score: Column, full_mark: Column) -> Column:
    """``h`` when the knowledge-point score reaches half its full mark, ``l`` below, null when unknown."""
    half = full_mark.cast("double") / 2.0
    return F.when(score >= half, F.lit(HIGH)).when(score < half, F.lit(LOW))


def tag(id_col: Column, label: Column) -> Column:
    """The reference's transaction item: id and label glued, e.g. ``3t`` or ``12h``."""
    return F.concat(id_col.cast("string"), label)

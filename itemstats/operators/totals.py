"""Student totals, sample sizes and the 27 % high / low groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from itemstats.defaults import GROUP_FRACTION
from itemstats.functions.sizing import small_side, stored
from itemstats.operators.ranking import rank_in_group
from itemstats.operators.reshape import cell, score_type, with_papers
from itemstats.schema import BATCH_KEYS, STUDENT_KEYS
from itemstats.session import ensure_checkpoint_dir

MISSING_MODES = ("propagate", "zero")


def total_score(sheets: DataFrame, items: DataFrame, missing: str = "propagate") -> DataFrame:
    """Add ``total_score`` (int) to each sheet: the sum over the paper's items.

    ``missing="propagate"``: null when any cell of the paper is missing or null,
    as the reference's ``item1.i1 + item1.i2 + ...``.  ``"zero"``: missing cells
    count 0, and ``cells`` holds those zeros, so item statistics read the same sample.
    Also adds ``item_ids`` and ``n_items`` of the paper.
    """
    if missing not in MISSING_MODES:
        raise ValueError(f"missing must be one of {MISSING_MODES}")
    s = with_papers(sheets, items)
    scores = F.transform("item_ids", lambda i: cell(F.col("cells"), i))
    kind = score_type(sheets)
    if missing == "zero":
        scores = F.transform(scores, lambda x: F.coalesce(x, F.lit(0).cast(kind)))
        s = s.withColumn("cells", F.map_from_arrays("item_ids", scores))
        scores = F.map_values("cells")
    total = F.aggregate(scores, F.lit(0).cast(kind), lambda acc, x: (acc + x).cast(kind))
    return s.withColumn("total_score", total.cast(kind))


def group_sizes(totals: DataFrame, fraction: float = GROUP_FRACTION) -> DataFrame:
    """Per batch: ``n`` samples (null totals included) and ``pg = round(fraction * n)`` half up."""
    return (
        totals.groupBy(*BATCH_KEYS)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("pg", F.round(F.col("n") * F.lit(fraction)).cast("int"))
    )


def total_buckets(totals: DataFrame) -> DataFrame:
    """``totals`` with its bucket of the histogram, ``_tnull`` and ``_tval``, which join as equal values."""
    return totals.withColumn("_tnull", F.col("total_score").isNull()).withColumn(
        "_tval", F.coalesce(F.col("total_score"), F.lit(0).cast(totals.schema["total_score"].dataType))
    )


def group_takes(sizes: DataFrame, fraction: float) -> DataFrame:
    """How many samples each group takes (``_take_hi``, ``_take_lo``) from every bucket of ``_cnt``
    samples, with the batch's ``n_batch`` samples and group size ``pg``.

    The high group walks totals descending with nulls last, the low group
    ascending with nulls first.  The histogram has one row per distinct total,
    so its per-batch window is small whatever the number of students.
    """
    batch = Window.partitionBy(*BATCH_KEYS)
    hist = sizes.withColumn("n_batch", F.sum("_cnt").over(batch)).withColumn(
        "pg", F.round(F.col("n_batch") * F.lit(fraction)).cast("int")
    )
    high_first = [F.col("_tnull").asc(), F.col("_tval").desc()]
    low_first = [F.col("_tnull").desc(), F.col("_tval").asc()]
    for name, order in (("_take_hi", high_first), ("_take_lo", low_first)):
        before = F.coalesce(F.sum("_cnt").over(batch.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        hist = hist.withColumn(name, F.greatest(F.lit(0), F.least(F.col("_cnt"), F.col("pg") - before)))
    return hist


def _histogram(totals: DataFrame, fraction: float) -> DataFrame:
    """Students per (batch, total score), with how many each group takes from the bucket."""
    sizes = totals.groupBy(*BATCH_KEYS, "_tnull", "_tval").agg(F.count(F.lit(1)).alias("_cnt"))
    return group_takes(sizes, fraction).withColumnRenamed("n_batch", "n")


def high_low_groups(totals: DataFrame, fraction: float = GROUP_FRACTION) -> DataFrame:
    """Add ``is_high`` / ``is_low`` (and ``n``, ``pg``) to rows keyed by sample with ``total_score``.

    High group: the ``pg`` samples first by total descending, null totals last;
    low group: the ``pg`` first by total ascending, null totals first
    (the reference's ``orderBy(...).limit(n)``).  Ties at the cut are broken by
    ``stu_code`` then ``attempt`` (D1).

    No global sort and no window over a whole batch: a histogram of totals fixes
    the cut score of each batch; samples strictly inside the cut are settled
    directly and only those *at* the cut score are ranked, with
    :func:`rank_in_group`, which stays distributed even under mass ties.  The
    ranks come back by a broadcast join when they are few (the usual case) and
    by a shuffle join on the sample key otherwise; the sheets are read once.
    """
    ensure_checkpoint_dir(totals.sparkSession)
    t = total_buckets(totals)
    hist = small_side(
        _histogram(t, fraction).select(*BATCH_KEYS, "_tnull", "_tval", "n", "pg", "_cnt", "_take_hi", "_take_lo")
    )
    full = t.join(hist, [*BATCH_KEYS, "_tnull", "_tval"])
    partial = ((F.col("_take_hi") > 0) & (F.col("_take_hi") < F.col("_cnt"))) | (
        (F.col("_take_lo") > 0) & (F.col("_take_lo") < F.col("_cnt"))
    )
    tie_key = F.concat(F.col("stu_code"), F.lit("\u0001"), F.lpad(F.col("attempt").cast("string"), 10, "0"))
    ties = stored(full.filter(partial).select(*STUDENT_KEYS, "_tnull", "_tval", tie_key.alias("_tie")))
    # samples off the cut score have no rank: their bucket is wholly in (take = cnt) or out (take = 0)
    if ties.count() == 0:
        flagged = full.withColumn("_rank", F.lit(None).cast("long"))
    else:
        ranks = small_side(
            rank_in_group(ties, [*BATCH_KEYS, "_tnull", "_tval"], F.col("_tie"), "_rank").select(*STUDENT_KEYS, "_rank")
        )
        flagged = full.join(ranks, STUDENT_KEYS, "left")
    rank = F.col("_rank")
    return (
        flagged.withColumn("is_high", F.when(rank.isNull(), F.col("_take_hi") > 0).otherwise(rank < F.col("_take_hi")))
        .withColumn("is_low", F.when(rank.isNull(), F.col("_take_lo") > 0).otherwise(rank < F.col("_take_lo")))
        .drop("_tnull", "_tval", "_cnt", "_take_hi", "_take_lo", "_rank")
    )


def score_totals(sheets: DataFrame, items: DataFrame, missing: str = "propagate") -> DataFrame:
    """The ``t_score_total`` result: ``(paper_code, create_time, stu_code, attempt, total_score)``."""
    return total_score(sheets, items, missing).select(*STUDENT_KEYS, "total_score")

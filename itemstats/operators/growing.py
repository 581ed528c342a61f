"""Statistics of batches that grow: late samples are merged, earlier ones are not read again.

A delta (a late file, a micro-batch) is reduced to *moments*: per batch, total score and item the number of
samples, of scores, their sum, sum of squares, maximum and minimum.  Moments of any number of deltas merge by
adding up, and hold all that the item and paper statistics need:

* sizes, the histogram of totals and so the cut of the high / low groups;
* every item's maximum, minimum, mean, variance and sum;
* an item's sum over a group, as far as whole buckets of the histogram belong to it.

Only samples *at* a cut score that a group takes in part must be known one by one, to rank them by
``stu_code, attempt`` (D1).  The samples are therefore kept beside the moments, sorted by total, and only those
with a cut's total are read: two totals a batch.

State: Parquet below ``root``, partitioned by batch and ``epoch``.  Adding an epoch again (a replayed
micro-batch, a run that died between the two tables) replaces what it wrote, so each delta counts once.
Moments are as large as the histograms (distinct totals x items a batch), whatever the number of students; they
are aggregated before the shuffle, so a batch with a third of all samples is no hot key.

Defined cases: null totals are a bucket of their own, last for the high group and first for the low one; missing
cells are skipped or count 0 as ``missing`` says (the same for every delta); papers without a blueprint are left
out; a sample's key (``stu_code, attempt``) names it in the whole batch, and a key given again in a later epoch
is a sample of its own, ranked after the earlier one; a state without samples gives empty results.  Sums of
squares are doubles: exact for whole and half marks up to 2^53.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from itemstats.defaults import GROUP_FRACTION
from itemstats.functions.sizing import checked, small_side, stored
from itemstats.operators import item_stats, paper_stats
from itemstats.operators.ranking import rank_in_group
from itemstats.operators.reshape import cell
from itemstats.operators.totals import group_takes, total_buckets, total_score
from itemstats.schema import BATCH_KEYS, ITEM_INDEX_COLUMNS

KEYS = ", ".join(f"{k} string" for k in BATCH_KEYS) + ", epoch long"


def moments(totals: DataFrame) -> DataFrame:
    """Per (batch, total score, item) of sheets with totals: ``samples, n, total, squares, top, low``."""
    cells = totals.select(*BATCH_KEYS, "total_score", "cells", F.explode("item_ids").alias("item_id"))
    score = cell(F.col("cells"), F.col("item_id"))
    cells = cells.select(*BATCH_KEYS, "total_score", "item_id", score.alias("score"))
    return cells.groupBy(*BATCH_KEYS, "total_score", "item_id").agg(
        F.count(F.lit(1)).alias("samples"),
        F.count("score").alias("n"),
        F.sum(F.col("score").cast("double")).alias("total"),
        F.sum(F.col("score").cast("double") * F.col("score").cast("double")).alias("squares"),
        F.max("score").alias("top"),
        F.min("score").alias("low"),
    )


def add(sheets: DataFrame, items: DataFrame, root: str, epoch: int, missing: str = "propagate") -> DataFrame:
    """Add the samples of ``sheets`` to the state at ``root`` as ``epoch``; the batches it touched."""
    totals = stored(total_score(sheets, items, missing).select(*BATCH_KEYS, "stu_code", "attempt", "total_score", "cells", "item_ids"))
    # samples first: moments without their samples would never be ranked, samples without moments never count
    _replace(totals.drop("item_ids"), f"{root}/samples", epoch)
    _replace(moments(totals), f"{root}/moments", epoch)
    return totals.select(*BATCH_KEYS).distinct()


def _replace(df: DataFrame, path: str, epoch: int) -> None:
    out = df.withColumn("epoch", F.lit(epoch).cast("long")).hint("rebalance", *BATCH_KEYS)
    out = out.sortWithinPartitions(*BATCH_KEYS, "epoch", "total_score")
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*BATCH_KEYS, "epoch").parquet(path)


def _read(spark: SparkSession, root: str, name: str, columns: str, batches: DataFrame | None) -> DataFrame:
    df = spark.read.schema(f"{columns}, {KEYS}").parquet(f"{root}/{name}")
    return df if batches is None else df.join(batches, BATCH_KEYS, "left_semi")


def variance(n: Column, total: Column, squares: Column, top: Column, low: Column) -> Column:
    """Population variance from sums; exactly 0 where all values are equal, null without a value."""
    n = n.cast("double")
    spread = F.greatest(n * squares - total * total, F.lit(0.0))
    return F.when(n > 0, F.when(top == low, F.lit(0.0)).otherwise(spread / (n * n)))


def statistics(
    spark: SparkSession, root: str, items: DataFrame, batches: DataFrame | None = None,
    fraction: float = GROUP_FRACTION, score_type: str = "int", rounded: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``t_item_index`` and ``t_paper_index`` of the state's batches (or of ``batches`` alone)."""
    if batches is not None:
        batches = small_side(batches.select(*BATCH_KEYS).distinct())
    value = f"total_score {score_type}"
    held = _read(spark, root, "moments", f"{value}, item_id int, samples long, n long, total double, squares double, top {score_type}, low {score_type}", batches)
    merged = held.groupBy(*BATCH_KEYS, "total_score", "item_id").agg(
        *[F.sum(c).alias(c) for c in ("samples", "n", "total", "squares")], F.max("top").alias("top"), F.min("low").alias("low")
    )
    merged = stored(total_buckets(merged))
    # a sample has a row for each item of its paper: any item's count is the bucket's
    sizes = merged.groupBy(*BATCH_KEYS, "_tnull", "_tval").agg(F.max("samples").alias("_cnt"))
    hist = small_side(group_takes(sizes, fraction))

    whole = merged.join(hist, [*BATCH_KEYS, "_tnull", "_tval"])
    sums = whole.select(
        *BATCH_KEYS, "item_id", "samples", "n", "total", "squares", "top", "low", F.col("n_batch"), "pg",
        F.when(F.col("_take_hi") == F.col("_cnt"), F.col("total")).alias("hi"),
        F.when(F.col("_take_lo") == F.col("_cnt"), F.col("total")).alias("lo"),
    )
    cut = _at_cut(spark, root, hist, f"stu_code string, attempt int, {value}, cells map<int,{score_type}>")
    if cut is not None:
        sums = sums.unionByName(cut, allowMissingColumns=True)
    n, total, squares, top, low = F.sum("n"), F.sum("total"), F.sum("squares"), F.max("top"), F.min("low")
    fc = variance(n, total, squares, top, low)
    per_item = sums.groupBy(*BATCH_KEYS, "item_id").agg(
        top.alias("max_score"), low.alias("min_score"), F.when(n > 0, total / n).alias("avg_score"), fc.alias("fc_score"), F.sqrt(fc).alias("bzc_score"),
        total.alias("_sum"), F.sum("hi").alias("_sum_hi"), F.sum("lo").alias("_sum_lo"), F.max("n_batch").alias("_n"), F.max("pg").alias("_pg"),
    )
    item_index = stored(item_stats.from_sums(per_item, items).select(*ITEM_INDEX_COLUMNS))

    t, c = F.when(~F.col("_tnull"), F.col("_tval")), F.when(~F.col("_tnull"), F.col("_cnt"))
    n, total, top, low = F.sum(c), F.sum(c * t.cast("double")), F.max(t), F.min(t)
    fc = variance(n, total, F.sum(c * t.cast("double") * t.cast("double")), top, low)
    paper = hist.groupBy(*BATCH_KEYS).agg(
        top.alias("max_score"), low.alias("min_score"), (total / n).alias("avg_score"), fc.alias("fc_score"), F.sqrt(fc).alias("bzc_score")
    )
    return item_index, paper_stats.from_totals(paper, item_index, items, rounded)


def _at_cut(spark: SparkSession, root: str, hist: DataFrame, columns: str) -> DataFrame | None:
    """Per (batch, item) the sums ``hi`` / ``lo`` over the samples a group takes from a bucket it shares."""
    high = (F.col("_take_hi") > 0) & (F.col("_take_hi") < F.col("_cnt"))
    low = (F.col("_take_lo") > 0) & (F.col("_take_lo") < F.col("_cnt"))
    shared = hist.filter(high | low).select(
        *BATCH_KEYS, "_tnull", "_tval", F.when(high, F.col("_take_hi")).otherwise(0).alias("_hi"), F.when(low, F.col("_take_lo")).otherwise(0).alias("_lo")
    )
    shared, n = checked(shared)
    if n == 0:
        return None
    samples = total_buckets(_read(spark, root, "samples", columns, None)).join(shared, [*BATCH_KEYS, "_tnull", "_tval"])
    order = [F.lpad(F.col(c).cast("string"), w, "0") for c, w in (("attempt", 10), ("epoch", 19))]
    tie = F.concat_ws("\u0001", F.col("stu_code"), *order)
    ranked = rank_in_group(samples.drop("total_score"), [*BATCH_KEYS, "_tnull", "_tval"], tie, "_rank")
    cells = ranked.select(*BATCH_KEYS, "_rank", "_hi", "_lo", F.explode("cells").alias("item_id", "score"))
    score = F.col("score").cast("double")
    return cells.groupBy(*BATCH_KEYS, "item_id").agg(
        F.sum(F.when(F.col("_rank") < F.col("_hi"), score)).alias("hi"), F.sum(F.when(F.col("_rank") < F.col("_lo"), score)).alias("lo")
    )

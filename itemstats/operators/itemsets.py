"""Frequent itemsets of all batches in one pass over blocks (M2).

Equal transactions of a batch become one row with a weight.  Batches are cut into blocks of about ``ROWS``
such rows by the hash of the transaction, and every block is mined by itself, depth first over the rows that
hold the itemset so far, at the batch's threshold scaled to the block: an itemset frequent in the whole
is frequent in at least one block, for if it were below its share in every one the counts could not add up.
A batch of one block, the common case, is settled there.  The itemsets found in any block of a larger
batch are its candidates; they are counted in all its blocks, the sums are exact, and those below
the batch's count go.

So there is no job per batch, no list of labels on the driver and no task whose memory follows a batch:
a task holds one block, its frequent labels as columns, and the candidates of one batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemstats.functions.sizing import small_side, stored
from itemstats.schema import BATCH_KEYS
from itemstats.session import ship

#: Distinct transactions in a block.
ROWS = 20_000
FOUND = "paper_code string, create_time string, block int, items array<string>, freq long"


def frequent_itemsets(transactions: DataFrame, min_support: float) -> DataFrame:
    """``(paper_code, create_time, items array<string> sorted, freq, n)`` of every itemset that at least
    ``ceil(min_support * n)`` of the batch's n transactions hold.

    ``transactions(paper_code, create_time, ..., items array<string>)``: one row per sample; a label
    repeated in a transaction counts once, an empty transaction counts in n, null labels are left out.
    """
    ship(transactions.sparkSession)
    labels = F.array_sort(F.array_distinct(F.array_compact(F.coalesce("items", F.array().cast("array<string>")))))
    rows = stored(transactions.select(*BATCH_KEYS, labels.alias("items")).groupBy(*BATCH_KEYS, "items").agg(F.count(F.lit(1)).alias("weight")))
    sizes = rows.groupBy(*BATCH_KEYS).agg(F.sum("weight").alias("n"), F.count(F.lit(1)).alias("rows"))
    sizes = small_side(
        sizes.select(
            *BATCH_KEYS, "n", F.greatest(F.lit(1), F.ceil(F.col("n") * F.lit(float(min_support)))).cast("long").alias("min_count"),
            F.ceil(F.col("rows") / ROWS).cast("int").alias("blocks"),
        )
    )
    blocked = rows.join(sizes, BATCH_KEYS).withColumn("block", F.pmod(F.xxhash64("items"), F.col("blocks")).cast("int"))
    found = stored(blocked.groupBy(*BATCH_KEYS, "block").applyInArrow(_mine, FOUND)).join(sizes, BATCH_KEYS)
    whole = found.filter("blocks = 1 AND freq >= min_count").select(*BATCH_KEYS, "items", "freq", "n")
    if sizes.filter("blocks > 1").isEmpty():
        return whole
    candidates = found.filter("blocks > 1").select(*BATCH_KEYS, "items", "blocks").distinct()
    candidates = candidates.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(*BATCH_KEYS, "block", "items")
    split = blocked.filter("blocks > 1").groupBy(*BATCH_KEYS, "block")
    counted = split.cogroup(candidates.groupBy(*BATCH_KEYS, "block")).applyInArrow(_count, FOUND)
    sums = counted.groupBy(*BATCH_KEYS, "items").agg(F.sum("freq").alias("freq")).join(sizes, BATCH_KEYS)
    return whole.unionByName(sums.filter("freq >= min_count").select(*BATCH_KEYS, "items", "freq", "n"))


def _cells(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Row and label number of every label of the transactions, and the labels in order."""
    column = rows.column("items").combine_chunks()
    row = np.repeat(np.arange(len(column)), column.value_lengths().to_numpy(zero_copy_only=False))
    names = column.flatten().dictionary_encode()
    labels = names.dictionary.to_pylist()
    order = sorted(range(len(labels)), key=labels.__getitem__)
    place = np.empty(len(labels), np.int64)
    place[order] = np.arange(len(labels))
    return row, place[names.indices.to_numpy(zero_copy_only=False)] if len(row) else row, [labels[i] for i in order]


def _result(rows: pa.Table, items: list[list[str]], freq: list[int]) -> pa.Table:
    keys = [pa.array([rows.column(c)[0].as_py()] * len(items), t) for c, t in (*((k, pa.string()) for k in BATCH_KEYS), ("block", pa.int32()))]
    return pa.Table.from_arrays([*keys, pa.array(items, pa.list_(pa.string())), pa.array(freq, pa.int64())], names=[*BATCH_KEYS, "block", "items", "freq"])


def _mine(rows: pa.Table) -> pa.Table:
    """Itemsets of one block that reach the batch's count in proportion to the block."""
    weight = rows.column("weight").to_numpy().astype(np.int64)
    n, min_count = rows.column("n")[0].as_py(), rows.column("min_count")[0].as_py()
    least = max(1, -(-min_count * int(weight.sum()) // n))  # the smallest count c with c / block >= min_count / n
    row, label, names = _cells(rows)
    kept = np.flatnonzero(np.bincount(label, weight[row], len(names)) >= least)
    holds = np.zeros((len(weight), len(kept)), bool)
    at = np.searchsorted(kept, label)
    known = (at < len(kept)) & (kept[np.minimum(at, len(kept) - 1)] == label) if len(kept) else np.zeros(len(label), bool)
    holds[row[known], at[known]] = True
    items, freq = [], []
    ahead = [((), np.arange(len(weight)), np.arange(len(kept)))]
    while ahead:
        prefix, held, following = ahead.pop()
        inside = holds[np.ix_(held, following)]
        counts = weight[held] @ inside
        often = np.flatnonzero(counts >= least)
        for i in often.tolist():
            own = (*prefix, int(following[i]))
            items.append([names[kept[j]] for j in own])
            freq.append(int(counts[i]))
            later = following[often[often > i]]
            if len(later):
                ahead.append((own, held[inside[:, i]], later))
    return _result(rows, items, freq)


def _count(rows: pa.Table, candidates: pa.Table) -> pa.Table:
    """Counts of a batch's candidates in one block; those with a common start share its rows."""
    if not len(rows) or not len(candidates):
        return _result(candidates if len(candidates) else rows, [], [])
    weight = rows.column("weight").to_numpy().astype(np.int64)
    row, label, names = _cells(rows)
    number = {name: i for i, name in enumerate(names)}
    order = np.argsort(label, kind="stable")
    bounds = np.searchsorted(label[order], np.arange(len(names) + 1))
    by_label = [row[order[a:b]] for a, b in zip(bounds, bounds[1:])]
    items = sorted(candidates.column("items").to_pylist())
    freq, path, held = [], [], [np.arange(len(weight))]
    inside = np.zeros(len(weight), bool)
    for own in items:
        same = 0
        while same < min(len(path), len(own)) and path[same] == own[same]:
            same += 1
        path, held = path[:same], held[: same + 1]
        for name in own[same:]:
            if name in number:
                inside[by_label[number[name]]] = True
                held.append(held[-1][inside[held[-1]]])
                inside[:] = False
            else:
                held.append(held[-1][:0])
            path.append(name)
        freq.append(int(weight[held[-1]].sum()))
    return _result(rows, items, freq)

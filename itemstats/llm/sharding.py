"""Minimax contiguous sharding of documents (operator 10).

Law ``bytes``: documents with equal texts form one atomic group; groups are ordered by the SHA-256 of
their text, and the smallest shard capacity for which the ordered groups fit into the shards is found
by binary search with a greedy check.  A group larger than the mean load of the shards still open
would force the capacity up for everybody, so each such group (fewer than the number of shards by
arithmetic) gets a shard of its own first, and the search runs over the rest.

Scale: one range sort of slim rows (no text) by (hash, doc_id); running sizes are carried across
partitions by one total per partition.  The greedy check asks only "last group start at or before
x", so the driver holds a bounded index of group starts (``BLOCKS`` blocks, each with its smallest and
largest start and count) and follows the cuts as intervals; where the index cannot decide, the
windows around the cuts are indexed again more finely.  The result is exact.

Defined cases: null text has size 16, a null crc and is a group of its own per doc_id; empty text is
an ordinary text; rows repeated with the same doc_id each keep a slot; a null doc_id sorts first;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemstats.llm import common

BLOCKS = 32_768
ROW_BYTES = 16


def shard(docs: DataFrame, shards: int = 40, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` per row of ``docs``."""
    scratch = common.Scratch(docs.sparkSession, "shard")
    t = F.col(text)
    slim = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(t), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(t).alias("text_crc32"),
        F.unhex(F.sha2(F.coalesce(t, F.concat(F.lit("\0null:"), F.col(doc_id).cast("string"), F.lit(""))), 256)).alias("key"),
    ).withColumn("key", F.coalesce("key", F.unhex(F.lit("00"))))
    rows = common.ordered(scratch, slim, ["key", "doc_id"], _running)
    ends = rows.groupBy("part").agg(
        F.sum("size"), F.count("*"), F.min_by("key", "row"), F.max_by("key", "row")
    ).orderBy("part").collect()  # one row per shuffle partition
    at = common.with_part_values(rows, {
        "size_before": common.offsets({r[0]: r[1] for r in ends}),
        "rows_before": common.offsets({r[0]: r[2] for r in ends}),
        "continues": {0: 0} | {b[0]: int(a[4] == b[3]) for a, b in zip(ends, ends[1:])},
    })
    at = at.select(
        "doc_id", "size", "text_crc32", "key",
        (F.col("size_before") + F.col("before")).alias("pos"),
        (F.col("rows_before") + F.col("row")).alias("place"),
        F.when(F.col("row") == 0, F.col("continues") == 0).otherwise(F.col("new")).alias("start"),
    )
    giants = _giants(at, sum(r[1] for r in ends), shards)
    giant, pos, place = F.lit(False), F.col("pos"), F.col("place")
    for g in giants:  # fewer than ``shards``; the others close up as if a giant were not there
        giant = giant | (F.col("key") == F.lit(bytearray(g["key"])))
        pos = pos - F.when(F.col("pos") > g["pos"], F.lit(g["size"])).otherwise(0)
        place = place - F.when(F.col("place") > g["place"], F.lit(g["rows"])).otherwise(0)
    at = at.select("*", giant.alias("giant"), pos.alias("open_pos"), place.alias("open_place"))
    load = sum(r[1] for r in ends) - sum(g["size"] for g in giants)
    starts = at.filter(F.col("start") & ~F.col("giant")).select(F.col("open_pos").alias("pos"))
    cuts = _Cuts(starts, load, shards - len(giants)).solve() if load else []
    return _assign(at, cuts, giants, shards)


def _running(df: DataFrame) -> DataFrame:
    """Exclusive running size inside each sorted partition, and whether a row's group starts there
    (to be settled by the previous partition for a partition's first row)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size, prev = 0, None
        for b in batches:
            if not len(b):
                continue
            cs, key = b["size"].cumsum(), b["key"]
            b["before"] = size + cs - b["size"]
            same = key.eq(key.shift())
            same.iloc[0] = key.iloc[0] == prev
            b["new"] = ~same
            size, prev = size + int(cs.iloc[-1]), key.iloc[-1]
            yield b

    return df.mapInPandas(run, T.StructType([*df.schema.fields, T.StructField("before", T.LongType()), T.StructField("new", T.BooleanType())]))


def _giants(at: DataFrame, total: int, shards: int) -> list:
    """Groups above the mean load of the shards still open, largest first; fewer than ``shards``."""
    top = (
        at.groupBy("key").agg(F.sum("size").alias("size"), F.count("*").alias("rows"), F.min("pos").alias("pos"), F.min("place").alias("place"))
        .orderBy(F.desc("size"), "key").limit(shards).collect()
    )
    out, rest = [], total
    for r in top:
        free = shards - len(out)
        if free <= 1 or r["size"] * free <= rest:
            break
        out.append(r)
        rest -= r["size"]
    return out


class _Cuts:
    """Smallest capacity and its greedy cuts, from a bounded index of the sorted group starts."""

    def __init__(self, starts: DataFrame, total: int, shards: int):
        self.starts, self.total, self.shards, self.blocks, self.width = starts, total, shards, BLOCKS, None
        self.index([(0, total)])

    def index(self, windows: list[tuple[int, int]]) -> None:
        """Smallest start, largest start and count per block of the windows (inclusive bounds)."""
        merged: list[list[int]] = []
        for a, b in sorted(windows):
            if merged and a <= merged[-1][1] + 1:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        span = sum(b - a + 1 for a, b in merged)
        if self.width and -(-span // self.blocks) >= self.width:
            self.blocks *= 4  # too few blocks to tell the cuts apart
        self.width = width = max(1, -(-span // self.blocks))
        inside, block = F.lit(False), F.floor(F.col("pos") / F.lit(width))
        for a, b in merged:  # at most one window per cut
            inside = inside | F.col("pos").between(a, b)
        rows = (
            self.starts.filter(inside).groupBy(block.alias("k"))
            .agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.count("*").alias("n"))
            .orderBy("k").collect()
        )
        self.lo = np.array([*[r["lo"] for r in rows], self.total], "int64")
        self.hi = np.array([*[r["hi"] for r in rows], self.total], "int64")
        self.n = np.array([*[r["n"] for r in rows], 1], "int64")

    def last_start(self, x: int) -> tuple[int, int]:
        """Bounds of the last group start at or before x."""
        i = int(np.searchsorted(self.lo, x, "right")) - 1
        if i < 0:
            return 0, 0
        if x >= self.hi[i]:
            return int(self.hi[i]), int(self.hi[i])
        if self.n[i] <= 2:
            return int(self.lo[i]), int(self.lo[i])
        return int(self.lo[i]), int(min(x, self.hi[i] - 1))

    def walk(self, capacity: int) -> list[tuple[int, int]]:
        """Bounds of each greedy cut for ``capacity``."""
        low = high = 0
        out = []
        for _ in range(self.shards):
            low = self.last_start(low + capacity)[0]
            high = self.last_start(high + capacity)[1]
            out.append((low, high))
        return out

    def solve(self) -> list[int]:
        bad, good = -(-self.total // self.shards) - 1, self.total
        while good - bad > 1:
            mid = (bad + good) // 2
            low, high = self.walk(mid)[-1]
            if low >= self.total:
                good = mid
            elif high < self.total:
                bad = mid
            else:
                self.refine(bad, good)
        while any(a != b for a, b in self.walk(good)):
            self.refine(good, good)
        return [a for a, _ in self.walk(good)[:-1]]

    def refine(self, bad: int, good: int) -> None:
        self.index([(a, b) for (a, _), (_, b) in zip(self.walk(bad), self.walk(good))])


def _assign(at: DataFrame, cuts: list[int], giants: list, shards: int) -> DataFrame:
    """Shard by position, slot by rank inside the shard, both from carried row numbers."""
    shard_of, begin = sum([(F.col("open_pos") >= c).cast("int") for c in cuts], F.lit(0)), F.lit(0)
    rows = at.filter(~F.col("giant")).groupBy(shard_of.alias("shard")).count().collect()  # at most ``shards``
    run = 0
    for r in sorted(rows):
        begin = F.when(shard_of == r["shard"], F.lit(run)).otherwise(begin)
        run += r["count"]
    slot = F.col("open_place") - begin
    for i, g in enumerate(giants):
        hit = F.col("key") == F.lit(bytearray(g["key"]))
        shard_of = F.when(hit, shards - 1 - i).otherwise(shard_of)
        slot = F.when(hit, F.col("place") - F.lit(g["place"])).otherwise(slot)
    return at.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), shard_of.cast("int").alias("shard"),
        slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )

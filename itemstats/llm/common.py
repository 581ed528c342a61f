"""Helpers shared by the training-data operators: written intermediate tables, range-ordered rows
with a carried offset, hot-key joins and connected components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemstats.session import ensure_checkpoint_dir

#: Keys with more than total / HEAVY_KEYS rows are broadcast; there are fewer than this many by arithmetic.
HEAVY_KEYS = 10_000
#: Bits of the bitmap of keys that a join with wide rows is thinned by.
BITS = 1 << 22
#: Bytes of texts sent to a Python worker at once.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def task_partition() -> int:
    return TaskContext.get().partitionId()


def map_in_arrow(df: DataFrame, run: Callable, schema: T.StructType | str) -> DataFrame:
    """``df.mapInArrow`` for rows with whole texts, in batches of about ``BATCH_BYTES``.

    By rows alone (10,000) a batch of texts takes tens of MB, held several times outside the JVM's heap
    (vectors that double as they grow, the stream, the result) and in the worker.  The limit is a
    runtime option of the session, read when a plan runs; a session that names its own keeps it."""
    conf, limit = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(limit, None) is None:
        conf.set(limit, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


class Scratch:
    """Tables written below the shared checkpoint folder, so that lineage ends there and a lost
    executor costs a re-read.  ``free`` removes a table that no later plan reads."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.n = 0

    def write(self, df: DataFrame, *partition_by: str, options: dict | None = None) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.option("compression", "zstd").options(**options or {}).partitionBy(*partition_by).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def free(self, *tables: DataFrame) -> None:
        for t in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(t._scratch_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def ordered(scratch: Scratch, df: DataFrame, keys: Sequence[Column | str], each=None) -> DataFrame:
    """``df`` range-partitioned and sorted by ``keys`` and written, with ``part`` (partition) and
    ``row`` (position in it).  Equal leading keys are split by the later ones, so no key has to fit
    in one task.  ``each`` maps the sorted DataFrame (partition by partition) before it is written.  The
    order is read from the written table, never recomputed."""
    at = F.monotonically_increasing_id()
    df = df.repartitionByRange(partitions(scratch.spark), *keys).sortWithinPartitions(*keys)
    df = (each(df) if each else df).withColumn("_at", at)
    return scratch.write(
        df.withColumn("part", F.shiftright("_at", 33).cast("int"))
        .withColumn("row", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_at")
    )


def offsets(totals: dict[int, int]) -> dict[int, int]:
    """Sum of the totals of all earlier parts (one entry per partition)."""
    out, run = {}, 0
    for part in sorted(totals):
        out[part], run = run, run + totals[part]
    return out


def with_part_values(df: DataFrame, columns: dict[str, dict[int, int]]) -> DataFrame:
    """Add one long column per entry, looked up by ``part``: a broadcast of one row per partition."""
    spark = df.sparkSession
    names = list(columns)
    parts = sorted(set().union(*[columns[c].keys() for c in names]))
    rows = [(p, *[int(columns[c].get(p, 0)) for c in names]) for p in parts]
    small = spark.createDataFrame(rows, "part int, " + ", ".join(f"`{c}` long" for c in names))
    return df.join(F.broadcast(small), "part")


def join_keyed(big: DataFrame, keyed: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """Left join of ``big`` to ``keyed`` (one row per ``key``, whose ``count`` is its number of rows
    in ``big``).  Keys holding over total / HEAVY_KEYS rows are joined by broadcast (at most
    HEAVY_KEYS rows of them exist), all others by a shuffle in which no key is hot."""
    bound = max(1, total // HEAVY_KEYS)
    heavy = keyed.filter(F.col(count) > bound).drop(count)
    light = keyed.filter(F.col(count) <= bound).drop(count)
    hot = big.join(F.broadcast(heavy), key)
    rest = big.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key, "left")
    return hot.unionByName(rest)


def likely(df: DataFrame, key: Column, wanted: DataFrame) -> DataFrame:
    """``df`` with ``_likely``: false on rows whose ``key`` (a long) is surely not in ``wanted.key``.

    A bitmap of ``BITS`` hashed keys as a table of 64-bit words (at most BITS / 64 rows, broadcast).  It
    keeps wide rows that a join would leave alone out of that join's shuffle; the join stays exact."""
    bit = F.pmod(F.xxhash64(key), F.lit(BITS)).cast("int")

    def mask(b: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), b % 64)

    own = wanted.select(F.xxhash64("key").alias("_h")).select(F.pmod("_h", F.lit(BITS)).cast("int").alias("_b"))
    words = own.select(F.floor(F.col("_b") / 64).cast("int").alias("_word"), mask(F.col("_b")).alias("_m"))
    words = words.groupBy("_word").agg(F.bit_or("_m").alias("_bits"))
    out = df.withColumn("_b", bit).withColumn("_word", F.floor(F.col("_b") / 64).cast("int")).join(F.broadcast(words), "_word", "left")
    hit = F.coalesce(F.col("_bits").bitwiseAND(mask(F.col("_b"))) != 0, F.lit(False))
    return out.select(*df.columns, hit.alias("_likely"))


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a``, ``b`` longs), component = smallest node
    reachable.

    Alternating large-star and small-star rounds (each a grouping by node with a minimum, then one
    join of the edges to that minimum) until every component is a star around its smallest node;
    every round is written to the shared folder.  A node's neighbours are never gathered: the minimum
    is aggregated before the shuffle, and the join on a node with many edges is an ordinary shuffle
    join, which adaptive execution splits.  Empty edges give an empty table."""
    e = edges.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v")
    )
    e = scratch.write(e.distinct())
    while not _are_stars(e):
        # large star: every larger neighbour of u links to the smallest of u and its neighbours
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        e2 = scratch.write(_star(both, F.col("v") > F.col("u")).distinct())
        # small star: u and its smaller neighbours link to the smallest of them
        e3 = scratch.write(_star(e2, F.lit(True), own=True).distinct())
        scratch.free(e, e2)
        e = e3
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to a smaller node, or is the end of edges only."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    by = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return by.filter("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def _star(pairs: DataFrame, keep: Column, own: bool = False) -> DataFrame:
    low = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    out = pairs.filter(keep).join(low, "u").select(F.col("v").alias("x"), F.col("m"))
    if own:
        out = out.unionByName(low.select(F.col("u").alias("x"), "m"))
    return out.filter(F.col("x") != F.col("m")).select(F.col("x").alias("u"), F.col("m").alias("v"))

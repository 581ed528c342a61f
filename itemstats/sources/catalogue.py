"""A stored list of the batch files below a landing folder.

``list_batches`` lists every folder at each call.  The catalogue keeps the names: ``update`` lists the paper
folders of ``root`` (``<root>/<paper_code>/data.<ts>``), then opens only folders that changed since their mark,
the folder's time of change when it was listed, and appends what is new or gone.  Folders are listed in
tasks; neither names nor folders pass through the driver.

``<at>/files``: ``paper_code, ts, path, uri, length, present, run``; the last run of a path counts.
``<at>/folders``: ``paper_code, changed, run``, written after the names: an update that dies in between is
done again by the next one, which finds the same names and adds none twice.  A folder that changed less than
``SETTLE_NS`` before it was listed gets no mark and is listed again, so a file that arrives in the same tick of
the store's clock is not missed; on stores without a time for folders every folder is listed again.

A finished batch file is replaced as a whole (the collector renames it into place); a file whose length
changed is taken anew.  Folders that vanish take their files with them.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemstats.functions.sizing import stored
from itemstats.session import ship
from itemstats.sources.batches import batch_files
from itemstats.sources.blocks import located

SETTLE_NS = 2_000_000_000
FILES = "paper_code string, ts string, path string, uri string, length long, present boolean, run long"
FOLDERS = "paper_code string, changed long, run long"
GONE = -1  # the mark of a folder that vanished
#: Names handed on at once.
ROWS = 10_000


def _child(uri: str, name: str) -> str:
    return f"{uri.rstrip('/')}/{quote(name)}"


def _entries(uri: str) -> list[fs.FileInfo]:
    system, path = located(uri)
    return system.get_file_info(fs.FileSelector(path, allow_not_found=True))


def _batches(rows: Iterator[tuple], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*out), types)], names=names)

    for row in rows:
        out.append(row)
        if len(out) == ROWS:
            yield batch()
            out.clear()
    if out:
        yield batch()


def _folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for b in batches:
            for root in b.column("root").to_pylist():
                for e in _entries(root):
                    if e.type == fs.FileType.Directory:
                        yield e.base_name, _child(root, e.base_name), e.mtime_ns

    return _batches(rows(), ["paper_code", "folder", "changed"], [pa.string(), pa.string(), pa.int64()])


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for b in batches:
            for folder in b.column("folder").to_pylist():
                for e in _entries(folder):
                    if e.type == fs.FileType.File:
                        uri = _child(folder, e.base_name)
                        yield unquote(uri), uri, e.size

    return _batches(rows(), ["path", "uri", "length"], [pa.string(), pa.string(), pa.int64()])


def _table(spark: SparkSession, at: str, name: str, schema: str) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{at}/{name}")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{at}/{name}")


def files(spark: SparkSession, at: str) -> DataFrame:
    """``paper_code, ts, path, uri, length`` of the files present at the last update."""
    last = _table(spark, at, "files", FILES).groupBy("paper_code", "path").agg(F.max_by(F.struct("ts", "uri", "length", "present"), "run").alias("f"))
    return last.filter("f.present").select("paper_code", "f.ts", "path", "f.uri", "f.length")


def marks(spark: SparkSession, at: str) -> DataFrame:
    """``paper_code, mark`` of the folders whose listing is settled, and null marks of the others."""
    last = _table(spark, at, "folders", FOLDERS).groupBy("paper_code").agg(F.max_by(F.struct("changed"), "run").alias("m"))
    return last.select("paper_code", F.col("m.changed").alias("mark")).filter(~F.col("mark").eqNullSafe(F.lit(GONE)))


def update(spark: SparkSession, root: str, at: str) -> dict[str, int]:
    """Bring the catalogue ``at`` up to date with ``root``; returns the numbers of folders listed and of
    names added and gone."""
    ship(spark)
    run = time.time_ns()
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    root = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri().toString()
    here = spark.range(1).select(F.lit(root).alias("root")).mapInArrow(_folders, "paper_code string, folder string, changed long")
    here = here.filter(~F.col("paper_code").rlike("^[._]"))
    met = here.join(marks(spark, at).withColumn("known", F.lit(True)), "paper_code", "full")
    stale = stored(met.filter("folder IS NULL OR mark IS NULL OR changed IS NULL OR mark != changed"))
    listed = stale.filter("folder IS NOT NULL").repartition(n, "folder").mapInArrow(_names, "path string, uri string, length long")
    now = batch_files(listed).withColumn("present", F.lit(True))
    old = files(spark, at).join(stale.select("paper_code"), "paper_code", "left_semi")
    old = old.select("paper_code", "path", *[F.col(c).alias(f"old_{c}") for c in ("ts", "uri", "length")])
    both = now.join(old, ["paper_code", "path"], "full").filter("present IS NULL OR old_uri IS NULL OR length != old_length")
    delta = stored(
        both.select(
            "paper_code",
            *[F.coalesce(c, f"old_{c}").alias(c) for c in ("ts", "uri", "length")],
            "path",
            F.coalesce("present", F.lit(False)).alias("present"),
            F.lit(run).alias("run"),
        )
    )
    got = delta.agg(F.count_if("present").alias("added"), F.count_if(~F.col("present")).alias("gone")).first().asDict()
    columns = [c.split()[0] for c in FILES.split(", ")]
    if got["added"] or got["gone"]:
        delta.select(*columns).write.mode("append").parquet(f"{at}/files")
    settled = F.when(F.col("folder").isNull(), F.lit(GONE)).when(F.col("changed") < run - SETTLE_NS, F.col("changed"))
    fresh = stale.select("paper_code", settled.cast("long").alias("changed"), F.lit(run).alias("run"))
    if folders := stale.count():
        fresh.write.mode("append").parquet(f"{at}/folders")
    return {"folders": folders, **got}

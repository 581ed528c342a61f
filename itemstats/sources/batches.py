"""Batch choice: which ``data.<ts>`` file answers a request.

The collector writes ``<root>/<paper_code>/data.<ts>``; a request is
(paper_code, submit_time) and takes the first file whose ``ts`` is not before
the submit time (string order), or the latest file of the paper when none is
(the fallback the reference's comments ask for, D3).  In-progress files
(``data.<ts>.tmp``) and other names are ignored; dots elsewhere in the path do
not matter.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from itemstats.functions.sizing import small_side, stored
from itemstats.session import ensure_checkpoint_dir

from itemstats.sources.blocks import read_lines
from itemstats.sources.responses import BATCH_FILE

#: Chosen files named to one text scan; more are read from their table.
FEW_FILES = 10_000
PAPER_DIR = r"/([^/]+)/[^/]+$"


def list_batches(spark: SparkSession, root: str) -> DataFrame:
    """``(paper_code, ts, path, uri, length)`` for every batch file under ``root`` (contents are not read);
    ``uri`` is the encoded path by which a scan names its file.  It lists all folders:
    :mod:`itemstats.sources.catalogue` keeps the names between calls."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", F.col("_metadata.file_path").alias("uri"), "length")
    )
    return batch_files(files).select("paper_code", "ts", "path", "uri", "length")


def batch_files(files: DataFrame, path_col: str = "path") -> DataFrame:
    """Keep the paths named ``.../<paper_code>/data.<ts>``: ``(paper_code, ts, path)`` and other columns."""
    p = F.col(path_col)
    return files.select(
        F.regexp_extract(p, PAPER_DIR, 1).alias("paper_code"),
        F.regexp_extract(p, BATCH_FILE, 1).alias("ts"),
        p.alias("path"),
        *[c for c in files.columns if c not in (path_col, "paper_code", "ts")],
    ).filter(F.col("ts") != "")


def select_batch(files: DataFrame, requests: DataFrame, partitions: int | None = None) -> DataFrame:
    """Pick a batch per request.

    ``files(paper_code, ts, ...)``, ``requests(paper_code, submit_time)`` ->
    ``(paper_code, submit_time, create_time)`` where ``create_time`` is the
    smallest ``ts >= submit_time``, else the largest ``ts`` of the paper, else
    null (no file).

    Files and requests are merged into one stream and range-partitioned by
    (paper, time), so even a paper holding most of the files is spread over many
    tasks.  Inside a range partition each request looks ahead to the next file;
    a request with no file after it in its partition takes the earliest file of
    the later partitions of its paper, from a small table with one row per
    (partition, paper).  No request is ever paired with all files.
    """
    spark = files.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    f = files.select("paper_code", F.col("ts").alias("_t"), F.lit(0).alias("_req"), F.lit(None).cast("string").alias("submit_time"))
    r = requests.select("paper_code", F.col("submit_time").alias("_t"), F.lit(1).alias("_req"), "submit_time")
    # the partition ids come from sampled range bounds: materialise them once so every branch agrees
    ranged = (
        f.unionByName(r).repartitionByRange(n, "paper_code", "_t").withColumn("_pid", F.spark_partition_id()).checkpoint()
    )
    part = ["_pid", "paper_code"]
    # at an equal time the file comes first, so ts >= submit_time includes equality
    ahead = Window.partitionBy(*part).orderBy(F.col("_t").desc(), F.col("_req").asc()).rowsBetween(Window.unboundedPreceding, 0)
    file_ts = F.when(F.col("_req") == 0, F.col("_t"))
    local = ranged.withColumn("_next", F.min(file_ts).over(ahead)).filter(F.col("_req") == 1)
    firsts = ranged.groupBy(*part).agg(F.min(file_ts).alias("_first"))
    later = Window.partitionBy("paper_code").orderBy(F.col("_pid").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = small_side(firsts.withColumn("_carry", F.min("_first").over(later)).select(*part, "_carry"))
    last = small_side(ranged.groupBy("paper_code").agg(F.max(file_ts).alias("_last")))
    return (
        local.join(carry, part, "left")
        .join(last, "paper_code", "left")
        .select("paper_code", "submit_time", F.coalesce("_next", "_carry", "_last").alias("create_time"))
    )


def chosen_files(spark: SparkSession, root: str, requests: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """``(paper_code, submit_time, create_time, path, uri, length)`` per request; null where the paper has no
    file.  ``files`` (such as ``catalogue.files``) stands for a listing of ``root``."""
    files = list_batches(spark, root) if files is None else files
    return select_batch(files, requests).join(
        files.select("paper_code", F.col("ts").alias("create_time"), "path", "uri", "length"), ["paper_code", "create_time"], "left"
    )


def _lines(spark: SparkSession, root: str, requests: DataFrame, files: DataFrame | None, few_files: int) -> DataFrame:
    from itemstats.sources.responses import file_position

    chosen = stored(chosen_files(spark, root, requests, files).filter(F.col("path").isNotNull()))
    own = stored(chosen.select("path", "uri", "length").distinct())
    # the reader takes a bounded list of paths and then opens no other file; more files are planned as a table
    paths = [r["path"] for r in own.select("path").limit(few_files + 1).collect()] if files is None else []
    if files is not None or len(paths) > few_files:
        lines = read_lines(own)
        lines = lines.select("value", "uri", file_position(F.col("uri"), F.col("start"), F.col("line_start")).alias("_pos"))
    elif paths:
        lines = spark.read.text([_literal(p) for p in paths]).select("value", F.col("_metadata.file_path").alias("uri"), file_position().alias("_pos"))
    else:
        lines = spark.createDataFrame([], "value string, uri string, _pos string")
    return lines.join(small_side(chosen.select("uri", "paper_code", "submit_time")), "uri")


def _literal(path: str) -> str:
    """The path with the reader's wildcard characters escaped."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def read_requested(spark: SparkSession, root: str, requests: DataFrame, as_sheets: bool = False,
                   score_type: str = "double", files: DataFrame | None = None, few_files: int = FEW_FILES) -> DataFrame:
    """Responses (or, with ``as_sheets``, answer sheets) of the batches chosen for
    ``requests(paper_code, submit_time)`` under ``root``; only the chosen files are read.

    Rows are keyed by the request's paper and submit time, as the reference keys
    its results; a file chosen by two requests feeds both.  Every line of a chosen
    file counts, also one that names another paper (:func:`requested_rejects`).
    ``files`` (such as ``catalogue.files``) stands for a listing of ``root``; its files, and more than
    ``few_files`` chosen ones, are read by blocks planned from their table (:mod:`itemstats.sources.blocks`), so no list grows on the driver.
    """
    from itemstats.sources.responses import to_long, to_sheets

    parse = to_sheets if as_sheets else to_long
    return parse(_lines(spark, root, requests, files, few_files), create_time=F.col("submit_time"), order_col="_pos",
                 paper_code=F.col("paper_code"), score_type=score_type)


def requested_rejects(spark: SparkSession, root: str, requests: DataFrame, score_type: str = "double",
                      files: DataFrame | None = None, few_files: int = FEW_FILES) -> DataFrame:
    """``(create_time, reason, n)`` of what :func:`read_requested` could not use (or, for another
    ``paperCode``, used all the same), with ``no file`` for requests without one."""
    from itemstats.sources.responses import rejected

    none = chosen_files(spark, root, requests, files).filter(F.col("path").isNull())
    none = none.groupBy(F.col("submit_time").alias("create_time")).agg(F.count(F.lit(1)).alias("n"))
    out = rejected(_lines(spark, root, requests, files, few_files), create_time=F.col("submit_time"), paper_code=F.col("paper_code"), score_type=score_type)
    return out.unionByName(none.select("create_time", F.lit("no file").alias("reason"), "n"))

"""Result tables partitioned by batch.

The reference appended into Hive text tables partitioned by
``(paper_code, create_time)``, so a re-run doubled a batch (D6).  Here a
write replaces the batches present in the DataFrame (dynamic partition
overwrite), empties those that were analysed and gave no row, and leaves the
others alone, so re-running a batch, or a retried job, gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemstats.schema import BATCH_KEYS

# The reference's decimal widths (fixed values of its table definitions).
NARROW = {
    "t_item_index": {
        "avg_score": "decimal(4,3)", "fc_score": "decimal(4,3)", "bzc_score": "decimal(4,3)",
        "nandu": "decimal(4,3)", "qufendu": "decimal(4,3)",
    },
    "t_paper_index": {
        "avg_score": "decimal(5,3)", "fc_score": "decimal(7,3)", "bzc_score": "decimal(5,3)",
        "nandu": "decimal(5,3)", "qufendu": "decimal(5,3)", "xindu": "decimal(5,3)",
    },
}

# Column lists of the result tables, data columns first and batch keys last.
DDL = {
    "t_score_total": "stu_code string, attempt int, total_score double",
    "t_item_index": "item_id int, max_score double, min_score double, avg_score double, fc_score double, "
    "bzc_score double, nandu double, qufendu double",
    "t_paper_index": "max_score double, min_score double, avg_score double, fc_score double, bzc_score double, "
    "nandu double, qufendu double, xindu double",
    "t_item_fpg": "pre_order string, suf_order string, confidence double",
    "t_item_cluster": "stu_code string, attempt int, good_item string, bad_item string, centers int",
}

REPORT_DDL = {"t_left_out": "stu_code string, attempt int, reason string"}


def narrow(df: DataFrame, table: str) -> DataFrame:
    """Cast statistics to the reference's decimal widths; a value that does not fit
    becomes null (``try_cast``) instead of failing the job (D7)."""
    widths = NARROW.get(table, {})
    return df.select(*[F.col(c).try_cast(widths[c]).alias(c) if c in widths else F.col(c) for c in df.columns])


def ensure_tables(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create the database, the five result tables and the report of samples left out (Parquet, partitioned by batch) if missing."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{loc}")
    for table, cols in (DDL | REPORT_DDL).items():
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{table} ({cols}, paper_code string, create_time string) "
            "USING parquet PARTITIONED BY (paper_code, create_time)"
        )


def write_result(df: DataFrame, target: str, as_table: bool = False, analysed: DataFrame | None = None) -> None:
    """Replace the batches present in ``df`` at ``target`` (a path, or a table with ``as_table``).

    ``analysed(paper_code, create_time)`` lists the batches the run looked at: those without a row in
    ``df`` lose what an earlier run left.  Rows are brought together by batch before the write (large
    batches are split again by AQE), so a batch is a few files, not one per task."""
    cols = [c for c in df.columns if c not in BATCH_KEYS] + BATCH_KEYS
    out = df.select(*cols).hint("rebalance", *BATCH_KEYS)
    if analysed is not None:
        _clear(df.select(*BATCH_KEYS).distinct(), target, as_table, analysed)
    if as_table:
        # insertInto takes the overwrite mode from the session alone: without it every partition would go
        conf, mode = df.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
        before = conf.get(mode)
        conf.set(mode, "dynamic")
        try:
            out.write.insertInto(target, overwrite=True)
        finally:
            conf.set(mode, before)
    else:
        (
            out.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*BATCH_KEYS)
            .parquet(target)
        )


def _clear(present: DataFrame, target: str, as_table: bool, analysed: DataFrame) -> None:
    """Drop the partitions of analysed batches that are not among ``present`` and exist at ``target``."""
    spark = present.sparkSession
    if as_table:
        stored = spark.table(target).select(*BATCH_KEYS)
    else:
        path = spark._jvm.org.apache.hadoop.fs.Path(target)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(path) or not any(s.isDirectory() for s in fs.listStatus(path)):
            return
        stored = read_result(spark, target).select(*BATCH_KEYS)
    stale = stored.distinct().join(analysed.select(*BATCH_KEYS).distinct(), BATCH_KEYS, "left_semi")
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for r in stale.join(present, BATCH_KEYS, "left_anti").toLocalIterator():  # a partition at a time
        if as_table:
            spec = ", ".join("{} = '{}'".format(c, r[c].replace("\\", "\\\\").replace("'", "\\'")) for c in BATCH_KEYS)
            spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({spec})")
        else:
            part = "/".join(f"{c}={escape(r[c])}" for c in BATCH_KEYS)
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{target}/{part}"), True)


def read_result(spark: SparkSession, target: str, paper_code: str | None = None,
                create_time: str | None = None, as_table: bool = False) -> DataFrame:
    """Read a result back, pruned to one paper / batch when given (partition filters)."""
    if as_table:
        df = spark.table(target)
    else:
        # batch keys are strings: keep "0123" as written instead of inferring a number
        found = spark.read.parquet(target).schema
        schema = T.StructType(
            [T.StructField(f.name, T.StringType()) if f.name in BATCH_KEYS else f for f in found.fields]
        )
        df = spark.read.schema(schema).parquet(target)
    if paper_code is not None:
        df = df.where(F.col("paper_code") == F.lit(str(paper_code)))
    if create_time is not None:
        df = df.where(F.col("create_time") == F.lit(str(create_time)))
    return df

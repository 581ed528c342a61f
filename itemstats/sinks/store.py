"""All result tables of a batch replaced at once (K1, K3, D6): versioned folders and a manifest.

A commit writes the rows of every table below ``<root>/<table>/run=<id>``, partitioned by batch, then a
manifest, a Parquet table ``(table, paper_code, create_time, run)`` that names the run that holds each batch
of each table, and last one small file ``<root>/_commits/<number>`` with the manifest's name and the tables'
schemas.  The file is created only if it does not exist, which is the commit: before it readers see the old rows in every table, after it the
new ones in every table.  Of two commits at once one finds its number taken and merges its batches into the
manifest that won.  A batch that was analysed and gave no row is in the manifest without data, so what an
earlier run left of it is gone.

Readers take the highest number (or an older one, which stays readable until :func:`vacuum`), and join the
manifest to the table on its partition columns, so only folders of current batches are read.  The manifest has
one row per table and batch, is written and joined as a table and never collected.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemstats.functions.sizing import small_side, stored
from itemstats.schema import BATCH_KEYS

COMMITS, MANIFESTS = "_commits", "_manifests"
MANIFEST = "table string, paper_code string, create_time string, run string"
#: Commits that may be lost to others before one gives up.
ATTEMPTS = 20


class Conflict(RuntimeError):
    """Other commits took every number that was tried."""


def commit(results: dict[str, DataFrame], root: str, analysed: DataFrame | None = None) -> int:
    """Replace the batches of ``results`` (table name -> rows) below ``root``; the number of the commit.

    ``analysed(paper_code, create_time)`` lists the batches the run looked at (by default those with a row in
    any result): in every table of ``results`` they are replaced, also by nothing."""
    spark = next(iter(results.values())).sparkSession
    root, run = root.rstrip("/"), uuid.uuid4().hex
    for name, df in results.items():
        cols = [c for c in df.columns if c not in BATCH_KEYS] + BATCH_KEYS
        df.select(*cols).hint("rebalance", *BATCH_KEYS).write.partitionBy(*BATCH_KEYS).parquet(f"{root}/{name}/run={run}")
    if analysed is None:
        analysed = _union([_rows(spark, root, name, run, results[name]).select(*BATCH_KEYS) for name in results])
    batches = stored(analysed.select(*[F.col(k).cast("string").alias(k) for k in BATCH_KEYS]).distinct())
    mine = _union([batches.select(F.lit(name).alias("table"), *BATCH_KEYS, F.lit(run).alias("run")) for name in results])
    own = {name: T.StructType([f for f in df.schema.fields if f.name not in BATCH_KEYS]).jsonValue() for name, df in results.items()}
    for _ in range(ATTEMPTS):
        number = latest(spark, root)
        merged, schemas = mine, own
        if number:
            schemas = _commit(spark, root, number)["schemas"] | own
            kept = manifest(spark, root, number).alias("m").join(mine.alias("n"), _same("m", "n", ["table", *BATCH_KEYS]), "left_anti")
            merged = kept.unionByName(mine)
        name = uuid.uuid4().hex
        merged.write.parquet(f"{root}/{MANIFESTS}/{name}")
        if _publish(spark, f"{root}/{COMMITS}/{number + 1:020d}", json.dumps({"manifest": name, "schemas": schemas})):
            return number + 1
    raise Conflict(f"no free commit number below {root} after {ATTEMPTS} attempts")


def read(spark: SparkSession, root: str, table: str, paper_code: str | None = None, create_time: str | None = None,
         version: int | None = None) -> DataFrame:
    """The rows of ``table`` (its columns, then the batch keys) as of a commit, the last by default; a table
    that no commit wrote is an error, as a missing path is to Spark."""
    root = root.rstrip("/")
    number = latest(spark, root) if version is None else version
    schemas = _commit(spark, root, number)["schemas"] if number else {}
    if table not in schemas:
        raise ValueError(f"no commit below {root} wrote table {table}")
    schema = T.StructType.fromJson(schemas[table])
    columns = list(schema.names)
    for key in ("run", *BATCH_KEYS):
        schema = schema.add(key, "string")
    wanted = manifest(spark, root, number).filter(F.col("table") == table).select("run", *BATCH_KEYS)
    for key, value in zip(BATCH_KEYS, (paper_code, create_time)):
        if value is not None:
            wanted = wanted.filter(F.col(key) == F.lit(str(value)))
    rows = spark.read.schema(schema).option("basePath", f"{root}/{table}").parquet(f"{root}/{table}")
    rows = rows.alias("r").join(small_side(wanted).alias("w"), _same("r", "w", ["run", *BATCH_KEYS]), "left_semi")
    return rows.select(*columns, *BATCH_KEYS)


def manifest(spark: SparkSession, root: str, number: int) -> DataFrame:
    """The manifest of a commit."""
    root = root.rstrip("/")
    name = _commit(spark, root, number)["manifest"]
    return spark.read.schema(MANIFEST).parquet(f"{root}/{MANIFESTS}/{name}")


def latest(spark: SparkSession, root: str) -> int:
    """Number of the last commit, 0 before the first."""
    path, fs = _path(spark, f"{root.rstrip('/')}/{COMMITS}")
    if not fs.exists(path):
        return 0
    return max((int(s.getPath().getName()) for s in fs.listStatus(path) if s.getPath().getName().isdigit()), default=0)


def vacuum(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Delete run folders that none of the last ``keep`` commits names, and older commits; the runs deleted.

    Runs of commits that are being written are not told from failed ones: vacuum while no commit is under way."""
    root, number = root.rstrip("/"), latest(spark, root)
    held = [manifest(spark, root, n) for n in range(max(1, number - keep + 1), number + 1)]
    used = {r["run"] for m in held for r in m.select("run").distinct().toLocalIterator()}  # runs kept, not batches
    gone = []
    base, fs = _path(spark, root)
    for table in fs.listStatus(base) if fs.exists(base) else []:
        if table.isDirectory() and not table.getPath().getName().startswith("_"):
            for run in fs.listStatus(table.getPath()):
                name = run.getPath().getName().removeprefix("run=")
                if name not in used:
                    fs.delete(run.getPath(), True)
                    gone.append(name)
    for n in range(1, number - keep + 1):
        path, _ = _path(spark, f"{root}/{COMMITS}/{n:020d}")
        if fs.exists(path):
            fs.delete(_path(spark, f"{root}/{MANIFESTS}/{_commit(spark, root, n)['manifest']}")[0], True)
            fs.delete(path, False)
    return sorted(set(gone))


def _rows(spark: SparkSession, root: str, table: str, run: str, like: DataFrame) -> DataFrame:
    path = f"{root}/{table}/run={run}"
    keys = ", ".join(f"{k} string" for k in BATCH_KEYS)
    has = any(s.isDirectory() for s in _path(spark, path)[1].listStatus(_path(spark, path)[0]))
    return spark.read.schema(keys).parquet(path) if has else like.select(*BATCH_KEYS).limit(0)


def _same(a: str, b: str, columns: list[str]):
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _commit(spark: SparkSession, root: str, number: int) -> dict:
    p, fs = _path(spark, f"{root}/{COMMITS}/{number:020d}")
    stream = fs.open(p)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _publish(spark: SparkSession, path: str, text: str) -> bool:
    """Make ``text`` readable at ``path``, whole, if nothing is there: written beside it, then renamed
    without overwriting."""
    p, _ = _path(spark, path)
    manager = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration())
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{p.getParent().toString()}/_{uuid.uuid4().hex}")
    _, fs = _path(spark, path)
    stream = fs.create(beside, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    options = spark._jvm.org.apache.hadoop.fs.Options.Rename
    array = spark.sparkContext._gateway.new_array(options, 1)
    array[0] = options.NONE  # fails where the target exists
    try:
        manager.rename(beside, p, array)
        return True
    except Py4JJavaError as e:
        fs.delete(beside, False)
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise

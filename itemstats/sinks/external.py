"""Sinks outside the warehouse: JDBC tables and delimited text."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemstats.functions.sizing import stored
from itemstats.schema import BATCH_KEYS

#: Table of the runs that were committed, in the target database.
EPOCHS = "itemstats_epochs"
#: Column that numbers the rows of a staging table.
ROW = "itemstats_row"
#: Type of string keys in tables that a commit creates: they must be comparable, which not every database's
#: type for text is.
KEY_TYPE = "VARCHAR(255)"
#: Times a staging table is written before a commit gives up (a task that is run again after its rows
#: were stored leaves some of them twice).
STAGE_ATTEMPTS = 3


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
               mode: str = "append", num_partitions: int | None = None, batch_size: int = 1000,
               **options: str) -> None:
    """Append ``df`` to a database table (the reference's MySQL export).

    ``num_partitions`` caps the concurrent connections (Spark coalesces to it);
    appends are not idempotent: :func:`commit_jdbc` replaces batches instead (D6).  Other Spark JDBC write options
    (e.g. ``createTableColumnTypes``) pass through.
    """
    w = df.write.mode(mode).option("batchsize", str(batch_size)).options(**options)
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    w.jdbc(url, table, properties=properties or {})


def commit_jdbc(results: dict[str, DataFrame], url: str, properties: dict[str, str] | None = None, *,
                analysed: DataFrame | None = None, epoch: str | None = None, keys: Iterable[str] = BATCH_KEYS,
                num_partitions: int | None = None, column_types: dict[str, str] | None = None) -> bool:
    """Replace the batches of ``results`` (table name -> rows) in database tables, all or none.

    Rows are stored once, written by the executors to staging tables (``<table>_stg_<hash>``, overwritten by a
    re-run of the same epoch) and counted there: a row stored twice by a task that ran again is found by its
    number, and the table is staged anew.  One transaction then deletes from every target the batches
    of ``analysed`` (by default those with a row in any result), inserts the staged rows and records
    ``epoch`` in ``itemstats_epochs``.  A run killed before the commit leaves the targets as they were, one run again
    replaces its batches, and an epoch that is recorded is not applied again (returns False).  Nothing but
    statements and counts passes the driver.  Missing targets are created; ``column_types`` (column -> SQL type)
    sets the types of string columns, by default ``VARCHAR(255)`` for keys and the dialect's for others.
    """
    if not results:
        return False
    spark = next(iter(results.values())).sparkSession
    keys, properties, epoch = list(keys), dict(properties or {}), epoch or uuid.uuid4().hex
    types = column_types or {}
    with _connection(spark, url, properties) as con:
        _ensure_epochs(con)
        if _committed(con, epoch):
            return False
    quote = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier
    tag = hashlib.sha256(epoch.encode()).hexdigest()[:12]
    rows = {name: stored(df.withColumn(ROW, F.monotonically_increasing_id())) for name, df in results.items()}
    if analysed is None:
        every = [df.select(*keys) for df in rows.values()]
        analysed = every[0]
        for df in every[1:]:
            analysed = analysed.unionByName(df)
    batches = stored(analysed.select(*keys).distinct().withColumn(ROW, F.monotonically_increasing_id()))
    staged, batch_stage = {}, f"itemstats_batches_stg_{tag}"
    _stage(batches, url, batch_stage, properties, keys, types, num_partitions)
    for name, df in rows.items():
        staged[name] = f"{name}_stg_{tag}"
        _stage(df, url, staged[name], properties, keys, types, num_partitions)
        empty = df.drop(ROW).limit(0)
        write_jdbc(empty, url, name, properties, createTableColumnTypes=_types(empty, keys, types))
    with _connection(spark, url, properties) as con:
        _replace(con, {n: (staged[n], [quote(c) for c in rows[n].columns if c != ROW]) for n in rows}, batch_stage, [quote(k) for k in keys], epoch)
        for table in (*staged.values(), batch_stage):
            _run(con, f"DROP TABLE {table}")
    return True


def _types(df: DataFrame, keys: list[str], types: dict[str, str]) -> str:
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return ", ".join(f"`{c}` {types.get(c, KEY_TYPE)}" for c in text if c in keys or c in types)


def _stage(df: DataFrame, url: str, table: str, properties: dict[str, str], keys: list[str], types: dict[str, str], num_partitions: int | None) -> None:
    """Write ``df`` (stored, rows numbered) to ``table`` so that every row is there once."""
    want = df.count()
    for _ in range(STAGE_ATTEMPTS):
        write_jdbc(df, url, table, properties, "overwrite", num_partitions, createTableColumnTypes=_types(df, keys, types))
        with _connection(df.sparkSession, url, properties) as con:
            number = df.sparkSession._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(ROW)
            if _numbers(con, f"SELECT COUNT(*), COUNT(DISTINCT {number}) FROM {table}") == [want, want]:
                return
    raise RuntimeError(f"{table} does not hold each of {want} rows once after {STAGE_ATTEMPTS} attempts")


def _replace(con, tables: dict[str, tuple[str, list[str]]], batches: str, keys: list[str], epoch: str) -> None:
    """The transaction of a commit."""
    con.setAutoCommit(False)
    try:
        for name, (stage, columns) in tables.items():
            same = " AND ".join(f"(b.{k} = {name}.{k} OR (b.{k} IS NULL AND {name}.{k} IS NULL))" for k in keys)
            _run(con, f"DELETE FROM {name} WHERE EXISTS (SELECT 1 FROM {batches} b WHERE {same})")
            listed = ", ".join(columns)
            _run(con, f"INSERT INTO {name} ({listed}) SELECT {listed} FROM {stage}")
        _run(con, f"INSERT INTO {EPOCHS} (epoch) VALUES (?)", epoch)
        con.commit()
    except BaseException:
        con.rollback()
        raise
    finally:
        con.setAutoCommit(True)


@contextmanager
def _connection(spark: SparkSession, url: str, properties: dict[str, str]):
    jvm = spark._jvm
    if "driver" in properties:
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(properties["driver"])
    own = jvm.java.util.Properties()
    for k, v in properties.items():
        own.setProperty(k, v)
    con = jvm.java.sql.DriverManager.getConnection(url, own)
    try:
        yield con
    finally:
        con.close()


def _run(con, sql: str, *values: str) -> None:
    statement = con.prepareStatement(sql)
    try:
        for i, v in enumerate(values):
            statement.setString(i + 1, v)
        statement.execute()
    finally:
        statement.close()


def _numbers(con, sql: str, *values: str) -> list[int]:
    """The first row of a query of numbers."""
    statement = con.prepareStatement(sql)
    try:
        for i, v in enumerate(values):
            statement.setString(i + 1, v)
        found = statement.executeQuery()
        found.next()
        return [found.getLong(i + 1) for i in range(found.getMetaData().getColumnCount())]
    finally:
        statement.close()


def _ensure_epochs(con) -> None:
    found = con.getMetaData().getTables(None, None, "%", None)
    while found.next():
        if found.getString("TABLE_NAME").lower() == EPOCHS:
            return
    _run(con, f"CREATE TABLE {EPOCHS} (epoch VARCHAR(255) NOT NULL PRIMARY KEY)")


def _committed(con, epoch: str) -> bool:
    return _numbers(con, f"SELECT COUNT(*) FROM {EPOCHS} WHERE epoch = ?", epoch) == [1]


def delimited(df: DataFrame, sep: str = ",", keep_nulls: bool = True) -> DataFrame:
    """One text column, all columns joined by ``sep``.

    ``keep_nulls=True`` writes a null as an empty field so columns keep their
    positions; ``False`` is the reference's ``concat_ws``, which skips nulls.
    """
    cols = [F.col(c).cast("string") for c in df.columns]
    if keep_nulls:
        cols = [F.coalesce(c, F.lit("")) for c in cols]
    return df.select(F.concat_ws(sep, *cols).alias("value"))


def write_delimited(df: DataFrame, path: str, sep: str = ",", mode: str = "append", keep_nulls: bool = True) -> None:
    """Write ``df`` as delimited text lines under ``path``."""
    delimited(df, sep, keep_nulls).write.mode(mode).text(path)

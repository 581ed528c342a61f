"""Student codes: four two-digit parts (grade, major, class, number)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS = ("gc", "mc", "cc", "nc")


def code_parts(df: DataFrame, code_col: str = "stu_code") -> DataFrame:
    """Add ``gc``, ``mc``, ``cc``, ``nc``: characters 1-2, 3-4, 5-6, 7-8 of the code as ints
    (null when not numeric)."""
    code = F.col(code_col)
    for i, name in enumerate(PARTS):
        df = df.withColumn(name, code.substr(2 * i + 1, 2).try_cast("int"))
    return df


def join_code(gc: Column, mc: Column, cc: Column, nc: Column) -> Column:
    """Rebuild a code from its parts, each zero-padded to two digits."""
    return F.concat(*[F.lpad(p.cast("int").cast("string"), 2, "0") for p in (gc, mc, cc, nc)])

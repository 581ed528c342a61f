"""Lines of many chosen files, read by blocks that are planned from a table.

A text scan takes its files as a list of paths that the driver holds.  Here the files are rows
(``uri``, ``length``): each is cut into byte ranges, the ranges are dealt to the tasks, and every task
opens its own files, so a million chosen files cost the driver nothing and one huge file is spread over
many tasks.  A line belongs to the range in which its first byte lies.

Files are opened by ``pyarrow.fs``, thus in local (shared) folders, HDFS and the object stores it knows.
Lines end at LF, CR or CR LF, as in Spark's text scan; a byte order mark at the file's start is dropped and
bytes that are not UTF-8 are replaced.  Files without a byte give no line.  A file that cannot be opened
fails the job.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemstats.session import ship

#: Bytes of a range; also what one task reads at least of a larger file.
BLOCK = 128 << 20
CHUNK = 1 << 20
#: Bytes of lines handed on at once.
BATCH = 4 << 20
LINES = "value string, uri string, start long, line_start long"


@cache
def file_system(root: str) -> fs.FileSystem:
    """One per worker and store."""
    return fs.LocalFileSystem() if root in ("://", "file://") else fs.FileSystem.from_uri(root + "/")[0]


def located(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of an (encoded) URI and the file's path in it."""
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return file_system("file://"), unquote(parts.path)
    return file_system(f"{parts.scheme}://{parts.netloc}"), fs.FileSystem.from_uri(uri)[1]


def block_lines(file, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """``(position, line)`` of the lines of ``file`` that begin in ``[start, end)``."""
    at = max(start - 1, 0)
    file.seek(at)
    skip, held = start > 0, []  # what the byte before the range belongs to is the previous range's
    while True:
        data = file.read(CHUNK)
        held.append(data)
        if data and b"\n" not in data and b"\r" not in data:
            continue
        lines = b"".join(held).splitlines(True)
        # the last line may go on, or its CR be followed by an LF
        held = [lines.pop()] if data and lines and not lines[-1].endswith(b"\n") else []
        for line in lines:
            pos, at = at, at + len(line)
            if skip:
                skip = False
            elif pos >= end:
                return
            else:
                yield pos, line.rstrip(b"\r\n")
        if not data:
            return


def read_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["value", "uri", "start", "line_start"]
    types = [pa.string(), pa.string(), pa.int64(), pa.int64()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), types)], names=names)

    rows, size = [], 0
    for b in batches:
        for uri, start, end in zip(*(b.column(c).to_pylist() for c in ("uri", "start", "end"))):
            system, path = located(uri)
            with system.open_input_file(path) as file:
                for pos, line in block_lines(file, start, end):
                    line = line.removeprefix(b"\xef\xbb\xbf") if pos == 0 else line
                    rows.append((line.decode("utf-8", "replace"), uri, start, pos))
                    size += len(line) + 64
                    if size > BATCH:
                        yield batch(rows)
                        rows, size = [], 0
    if rows:
        yield batch(rows)


def ranges(files: DataFrame, block: int = BLOCK) -> DataFrame:
    """``uri, start, end`` of every range of ``files(uri, length)``."""
    starts = F.when(F.col("length") > 0, F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(block).cast("long")))
    cut = files.select("uri", "length", F.explode(starts).alias("start"))
    return cut.select("uri", "start", F.least(F.col("start") + block, F.col("length")).alias("end"))


def read_lines(files: DataFrame, block: int = BLOCK, partitions: int | None = None) -> DataFrame:
    """``value, uri, start, line_start`` for every line of ``files(uri, length)``, a row per file."""
    spark = files.sparkSession
    ship(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return ranges(files, block).repartition(n, "uri", "start").mapInArrow(read_blocks, LINES)

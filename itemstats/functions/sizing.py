"""Broadcast only what is proven small.

Lookup tables here are derived (per-paper item lists, score histograms,
centroids) and their size follows the number of papers and batches, not a
constant.  :func:`small_side` writes such a table once below the checkpoint folder
(one job; a reliable checkpoint computes its last stage twice), measures it, and hints a broadcast only under a bound on its
bytes; above it the join stays a shuffle join, where AQE splits hot keys.  Without the
check the planner's estimate of a derived table is often too large, so it
plans a sort-merge join that shuffles the big side by paper, a hot key.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemstats.session import ensure_checkpoint_dir

# Bytes of a broadcast table as measured by :func:`measured` (its JSON text, arrays included).
BROADCAST_BYTES = 64 << 20


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows of ``df`` and the bytes of their JSON text, an upper estimate of the rows' own size
    (a number is 8 bytes a row at least: 16 are added per column)."""
    text = F.octet_length(F.to_json(F.struct(*df.columns))) + 16 * len(df.columns)
    row = df.agg(F.count(F.lit(1)), F.sum(text.cast("long"))).first()
    return row[0], row[1] or 0


def checked(df: DataFrame, max_bytes: int | None = None) -> tuple[DataFrame, int]:
    """``df`` stored and its row count; broadcast-hinted when it measures at most ``max_bytes``."""
    df = stored(df)
    n, size = measured(df)
    return (F.broadcast(df) if size <= (BROADCAST_BYTES if max_bytes is None else max_bytes) else df), n


def small_side(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """``df`` stored, with a broadcast hint when it measures at most ``max_bytes``."""
    return checked(df, max_bytes)[0]


def stored(df: DataFrame, *partition_by: str) -> DataFrame:
    """``df`` written as Parquet below the session's checkpoint folder and read back: later reads are
    pruned to their columns (and to the partitions asked for), which a row checkpoint cannot do."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)

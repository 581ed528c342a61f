"""Analyse answer batches as they land (the collector's folder as a file stream).

The reference's collector drops ``<root>/<paper_code>/data.<ts>`` files and a
later batch job picks one.  Here Structured Streaming watches the folder:
each micro-batch holds whole new files, which are parsed straight into answer
sheets (keyed by their ``<ts>``) and run through :func:`itemstats.plans.pipeline.run`.
Results are written with dynamic partition overwrite, so a replayed
micro-batch rewrites the same batches and the sink stays exactly-once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from itemstats.defaults import GROUP_FRACTION
from itemstats.functions.sizing import stored
from itemstats.operators import growing
from itemstats.operators.reshape import blueprint_items
from itemstats.plans import pipeline
from itemstats.sinks.results import write_result
from itemstats.sources.batches import PAPER_DIR
from itemstats.sources.responses import BATCH_FILE, file_position, to_sheets


def landing_lines(spark: SparkSession, root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming lines of ``<root>/<paper>/data.<ts>`` files with their ``create_time`` (the ``ts``).
    In-progress ``.tmp`` files and other names are skipped."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(f"{root.rstrip('/')}/*/data.*").select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_block")
    )
    # the path is encoded: decode what the folder's name may hold ("+" stands for itself there)
    folder = F.url_decode(F.replace(F.regexp_extract("path", PAPER_DIR, 1), F.lit("+"), F.lit("%2B")))
    return lines.withColumn("create_time", F.regexp_extract("path", BATCH_FILE, 1)).withColumn("paper_code", folder).filter(F.col("create_time") != "")


def watch(spark: SparkSession, root: str, blueprint: DataFrame, target: str,
          item_knowledge: DataFrame | None = None, steps: str = "1",
          options: pipeline.Options | None = None, *, checkpoint: str,
          available_now: bool = False, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream; ``available_now=True`` processes what has landed and stops.

    ``checkpoint`` is the stream's own folder, on the shared store and the same at every start
    (the application's checkpoint folder is renamed by Spark each time, and a restart would replay
    all files).  A batch is keyed by its folder and ``<ts>``."""

    def each(batch: DataFrame, epoch: int) -> None:
        # row ids are taken in the micro-batch (streams cannot number rows); the scan order is the file's
        lines = batch.withColumn("_pos", file_position(F.col("path"), F.col("_block")))
        sheets = to_sheets(lines, create_time=F.col("create_time"), order_col="_pos", paper_code=F.col("paper_code"), score_type="double")
        pipeline.run(None, blueprint, target, item_knowledge, steps, options=options, sheets=sheets)

    w = landing_lines(spark, root, max_files_per_trigger).writeStream.foreachBatch(each).option(
        "checkpointLocation", checkpoint
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def follow(spark: SparkSession, root: str, blueprint: DataFrame, target: str, state: str, batch_of: Callable[[Column], Column], *,
           checkpoint: str, missing: str = "propagate", fraction: float = GROUP_FRACTION,
           available_now: bool = False, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Item and paper statistics of batches that many files make up, brought up to date as files land.

    ``batch_of`` gives a file's batch from its ``<ts>`` (its day, say).  A micro-batch is reduced to moments,
    merged with those at ``state`` (:mod:`itemstats.operators.growing`), and the batches it touched are
    written anew; the files of earlier micro-batches are not read again.  State is kept per epoch and a
    replayed epoch replaces its own, so each file counts once.  The moments lie in Parquet rather than in a
    keyed streaming state, where a batch with a third of all samples would meet one task."""
    items = blueprint_items(blueprint)

    def each(batch: DataFrame, epoch: int) -> None:
        lines = batch.withColumn("_pos", file_position(F.col("path"), F.col("_block")))
        sheets = to_sheets(lines, create_time=batch_of(F.col("create_time")), order_col="_pos", paper_code=F.col("paper_code"), score_type="double")
        touched = stored(growing.add(sheets, items, state, epoch, missing))
        results = growing.statistics(spark, state, items, touched, fraction, "double")
        for name, df in zip(("t_item_index", "t_paper_index"), results, strict=True):
            write_result(df, f"{target}/{name}", analysed=touched)

    w = landing_lines(spark, root, max_files_per_trigger).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()

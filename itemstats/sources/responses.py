"""Response batches: JSON lines with one nested row per student.

A line looks like ``{"stuCode":"01020304","paperCode":"77","item1":{"i1":2,"i2":0},"item2":{"i3":5}}``:
``item<k>`` is section ``k``, ``i<n>`` is item ``n`` numbered across the paper.
The set of sections and items differs between papers, so no schema is
inferred: each line is parsed to maps and exploded into the long
``responses`` table in a single pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from itemstats.functions.sizing import checked
from itemstats.operators.ranking import rank_in_group
from itemstats.operators.reshape import unique_cells
from itemstats.schema import STUDENT_KEYS

SECTION_KEY = r"^item(\d+)$"
ITEM_KEY = r"^i(\d+)$"
BATCH_FILE = r"(?:^|/)data[.]([^./]+)$"


def _numbered(lines: DataFrame, value_col: str, create_time: Column | None, order_col: str | None,
              paper_code: Column | None = None) -> DataFrame:
    """One row per valid line: ``STUDENT_KEYS`` and the parsed top-level map ``_m``.

    A student found on more than one line of a batch gets ``attempt`` 1, 2, ...
    in the order of ``order_col`` (a sortable string such as :func:`file_position`;
    by default the row order of ``lines``).  Lines are counted per student (an
    aggregation); the repeated students, normally few, are broadcast after a size
    check and only their lines are ranked, with the distributed
    :func:`rank_in_group`, so neither a window nor a shuffle of the raw lines is
    needed, and a junk code shared by a third of all lines stays spread out.
    """
    ct = create_time if create_time is not None else F.col("create_time")
    order = F.col(order_col) if order_col else F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0")
    top = F.from_json(F.col(value_col), "map<string,string>")
    paper = paper_code if paper_code is not None else F.lit(None)
    rows = lines.select(
        ct.cast("string").alias("create_time"), order.cast("string").alias("_order"), top.alias("_m"), paper.cast("string").alias("_paper")
    )
    rows = rows.filter(F.col("_m").isNotNull() & F.col("_m")["stuCode"].isNotNull()).select(
        F.coalesce(F.col("_paper"), F.col("_m")["paperCode"]).alias("paper_code"),
        "create_time",
        F.col("_m")["stuCode"].alias("stu_code"),
        "_order",
        "_m",
    )
    student = ["paper_code", "create_time", "stu_code"]
    repeated, n_repeated = checked(
        rows.groupBy(*student).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select(*student, F.lit(True).alias("_rep"))
    )
    if n_repeated == 0:
        return rows.withColumn("attempt", F.lit(1)).select(*STUDENT_KEYS, "_m")
    flagged = rows.join(repeated, student, "left")
    once = flagged.filter(F.col("_rep").isNull()).withColumn("attempt", F.lit(1))
    # frozen first: the ranking reads its input twice, and the order key must be the same both times
    multi = flagged.filter(F.col("_rep").isNotNull()).checkpoint()
    again = rank_in_group(multi, student, F.col("_order"), "_rank").withColumn(
        "attempt", (F.col("_rank") + 1).cast("int")
    )
    return once.unionByName(again.drop("_rank")).select(*STUDENT_KEYS, "_m")


def _section_cells(sv: Column) -> Column:
    """``{"i3": 5, ...}`` text -> its items as a map of texts (empty when unreadable)."""
    return F.coalesce(F.from_json(sv, "map<string,string>"), F.create_map().cast("map<string,string>"))


def _score(text: Column, score_type: str) -> Column:
    """One cell's number: an unreadable one is null and leaves its neighbours alone.  As ``int`` a
    whole number is kept in any spelling (``2``, ``2.0``, ``"2"``); a fraction needs ``double``."""
    number = text.try_cast("double")
    return number if score_type == "double" else F.when(number == F.floor(number), number.try_cast("int"))


def rejected(lines: DataFrame, value_col: str = "value", create_time: Column | None = None,
             paper_code: Column | None = None, score_type: str = "int") -> DataFrame:
    """What the parsers cannot use, as ``(create_time, reason, n)``: ``malformed line``,
    ``no stuCode``, ``unreadable section``, ``unreadable score``, and ``other paperCode`` for lines
    that name another paper than their folder's ``paper_code`` (they are analysed with it)."""
    ct = create_time if create_time is not None else F.col("create_time")
    paper = paper_code if paper_code is not None else F.lit(None)
    top = F.from_json(F.col(value_col), "map<string,string>")
    rows = lines.select(ct.cast("string").alias("create_time"), top.alias("_m"), paper.cast("string").alias("_paper"))
    sections = F.filter(F.map_entries("_m"), lambda e: e["key"].rlike(SECTION_KEY))
    parsed = F.transform(sections, lambda e: F.from_json(e["value"], "map<string,string>"))
    scores = F.flatten(F.transform(F.filter(parsed, lambda m: m.isNotNull()), lambda m: F.map_values(F.map_filter(m, lambda k, v: k.rlike(ITEM_KEY)))))
    count = lambda c: F.coalesce(c.cast("long"), F.lit(0))
    usable = F.col("_m").isNotNull() & F.col("_m")["stuCode"].isNotNull()
    reasons = {
        "malformed line": count(F.col("_m").isNull()),
        "no stuCode": count(F.col("_m").isNotNull() & F.col("_m")["stuCode"].isNull()),
        "unreadable section": F.when(usable, F.size(F.filter(parsed, lambda m: m.isNull()))).otherwise(0),
        "unreadable score": F.when(usable, F.size(F.filter(scores, lambda x: x.isNotNull() & _score(x, score_type).isNull()))).otherwise(0),
        "other paperCode": count(usable & F.col("_paper").isNotNull() & ~F.col("_m")["paperCode"].eqNullSafe(F.col("_paper"))),
    }
    pairs = F.array(*[F.struct(F.lit(k).alias("reason"), v.cast("long").alias("n")) for k, v in reasons.items()])
    out = rows.select("create_time", F.inline(pairs)).filter(F.col("n") > 0)
    return out.groupBy("create_time", "reason").agg(F.sum("n").alias("n"))


def to_long(lines: DataFrame, value_col: str = "value", create_time: Column | None = None,
            order_col: str | None = None, paper_code: Column | None = None, score_type: str = "int") -> DataFrame:
    """Parse JSON answer lines into ``responses``.

    ``create_time`` is the batch key (by default the ``create_time`` column of
    ``lines``); ``paper_code`` is the paper of the batch where the folder names it
    (the reference counts every line of a chosen file, whatever its ``paperCode``;
    by default a line's own).  Malformed lines and lines without ``stuCode`` are
    left out and counted by :func:`rejected`; scores are read cell by cell
    (``score_type`` ``int`` or ``double``); a
    cell that is null stays a row with a null score.  A student found on more
    than one line gets ``attempt`` 1, 2, ... in the order of ``order_col`` (the
    line's position in its file when read by :func:`read_responses`), so every
    line stays one sample, as in the reference.
    """
    rows = _numbered(lines, value_col, create_time, order_col, paper_code)
    sections = rows.select(*STUDENT_KEYS, F.explode("_m").alias("_sk", "_sv")).filter(
        F.col("_sk").rlike(SECTION_KEY)
    )
    cells = sections.select(
        *STUDENT_KEYS,
        F.regexp_extract("_sk", SECTION_KEY, 1).cast("int").alias("section"),
        F.explode(_section_cells(F.col("_sv"))).alias("_ik", "score"),
    ).filter(F.col("_ik").rlike(ITEM_KEY))
    return cells.select(
        *STUDENT_KEYS,
        "section",
        F.regexp_extract("_ik", ITEM_KEY, 1).cast("int").alias("item_id"),
        _score(F.col("score"), score_type).alias("score"),
    )


def to_sheets(lines: DataFrame, value_col: str = "value", create_time: Column | None = None,
              order_col: str | None = None, paper_code: Column | None = None, score_type: str = "int") -> DataFrame:
    """Parse JSON answer lines straight into answer sheets (``STUDENT_KEYS``, ``cells``).

    A line already holds one sample, so its sections are flattened into the
    ``map<item, score>`` inside the row: the attempt numbering is the only
    shuffle, where :func:`to_long` followed by ``answer_sheets`` would shuffle
    the input twice.  Same parsing rules as :func:`to_long`.
    """
    rows = _numbered(lines, value_col, create_time, order_col, paper_code)
    sections = F.map_filter("_m", lambda k, v: k.rlike(SECTION_KEY))
    entries = F.flatten(
        F.transform(
            F.map_entries(sections),
            lambda e: F.transform(
                F.map_entries(F.map_filter(_section_cells(e["value"]), lambda k, v: k.rlike(ITEM_KEY))),
                lambda c: F.struct(
                    F.regexp_extract(c["key"], ITEM_KEY, 1).cast("int").alias("item_id"),
                    _score(c["value"], score_type).alias("score"),
                ),
            ),
        )
    )
    return rows.select(*STUDENT_KEYS, entries.alias("_e")).select(*STUDENT_KEYS, unique_cells(F.col("_e")).alias("cells"))


def read_responses(spark: SparkSession, path: str | list[str], create_time: str | None = None, score_type: str = "double") -> DataFrame:
    """Read answer files (JSON lines) into ``responses``.

    ``create_time`` names the batch (the reference keys results by the submit
    time); by default it is the ``<ts>`` of the file name ``data.<ts>``.
    """
    paths = [path] if isinstance(path, str) else list(path)
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("_file"), file_position().alias("_pos"))
    ct = F.lit(create_time) if create_time is not None else F.regexp_extract("_file", BATCH_FILE, 1)
    return to_long(lines, create_time=ct, order_col="_pos", score_type=score_type)


def read_sheets(spark: SparkSession, path: str | list[str], create_time: str | None = None, score_type: str = "double") -> DataFrame:
    """Read answer files straight into answer sheets (see :func:`to_sheets`)."""
    paths = [path] if isinstance(path, str) else list(path)
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("_file"), file_position().alias("_pos"))
    ct = F.lit(create_time) if create_time is not None else F.regexp_extract("_file", BATCH_FILE, 1)
    return to_sheets(lines, create_time=ct, order_col="_pos", score_type=score_type)


def file_position(path: Column | None = None, block: Column | None = None, row: Column | None = None) -> Column:
    """Where a line sits: a sortable text of (file, split start, row number within the split).

    Taken straight off the scan, it follows the file's line order and is the same
    when a split is re-read after a lost executor.  Files are ordered by a hash
    of their path (fixed, arbitrary); lines of one file by position.
    """
    path = path if path is not None else F.col("_metadata.file_path")
    block = block if block is not None else F.col("_metadata.file_block_start")
    row = row if row is not None else F.monotonically_increasing_id()

    def hex16(c: Column) -> Column:
        return F.lpad(F.hex(c), 16, "0")

    return F.concat(hex16(F.xxhash64(path)), hex16(block), hex16(row))

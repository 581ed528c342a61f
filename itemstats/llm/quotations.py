"""Conversations in reply order by quotation linking (operator 4).

A message's lines are read with their quote level (the ``>`` marks they start with).  Lines of one
level that follow each other form a quoted passage.  Every quoted passage, each of its lines and each
of its sentences is normalised (lower case, runs of anything but letters and digits as one blank) and
hashed; the hashes are joined to those of the lines, sentences and whole bodies of earlier messages of
the same conversation, as their authors wrote them, so a part of a message whose lines a mail program
broke anew is found by its sentences.  A message replies to the message that holds most words of its
outermost quotes (the latest of several); one without a linked quote replies to the message before it.
The conversation is returned in reply order: every message after the one it answers, a branch after the
branch it left, and the text without its quotes and the attribution lines above them.

Scale: only messages with quotes take part in the join, on (conversation, hash); a line that a
third of all messages share is reduced to (conversation, hash, message) first, and of equal lines
before a quote only the latest message counts.  A message opens a branch only if it quotes another
message than the one before it.  The branches of a conversation are a tree; its walk is a linked list
(enter, then the branches inside, leave), ranked by pointer doubling: one join of rows of fixed width
per doubling, log2 of the longest list in all, however deep quotes are nested.  Order and place in a
conversation come from a range sort with carried offsets, so one conversation may hold a third of all
rows, and siblings are linked in a range sort too, so any number may answer one message.

Defined cases: null texts are empty messages; a message that is only a quote keeps an empty text;
blank quoted lines link with nothing; equal (conversation, turn) rows are ordered by role and text
and each keeps a place; a null conversation or turn is a value of its own, first in order; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemstats.llm import common

QUOTE = r"^\s{0,3}((?:>\s?)+)"
#: The line above a quote that names its author.
ATTRIBUTION = r"(?i)^\s*(on\b.*\bwrote|.*\b(wrote|writes|said|schrieb|a écrit|escribió))\s*:\s*$"

#: Sentences end at a mark with white space behind it, and at blank lines.
SENTENCE_END = r"(?<=[.!?…])\s+|\n\s*\n"
#: Before every branch: the place of the messages ahead of a conversation's first one.
ROOT = -(1 << 62)


def normal(text: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def parsed(messages: DataFrame) -> DataFrame:
    """Adds ``lines`` (level, body), ``own`` (text without quotes) and ``quoted`` (level-1 bodies)."""
    lines = F.transform(
        F.split(F.coalesce("text", F.lit("")), r"\r?\n", -1),
        lambda x: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(x, QUOTE, 1), r"\s", "")).alias("level"), F.regexp_replace(x, QUOTE, "").alias("body")
        ),
    )
    out = messages.withColumn("lines", lines)
    # an attribution goes with the quote below it
    level = lambda i: F.coalesce(F.get("lines.level", i), F.lit(0))
    kept = F.filter("lines", lambda x, i: (x["level"] == 0) & ~(x["body"].rlike(ATTRIBUTION) & (level(i + 1) > 0)))
    own = F.btrim(F.regexp_replace(F.array_join(F.transform(kept, lambda x: x["body"]), "\n"), r"\n{3,}", "\n\n"), F.lit(" \n\t\r"))
    return out.withColumn("own", own)


def _hashes(rows: DataFrame) -> DataFrame:
    """(conv_id, mid, h) of a message's own lines, sentences and whole body: what a quote of it can repeat."""
    own = F.array_distinct(F.concat(F.split("own", "\n", -1), F.split("own", SENTENCE_END, -1), F.array("own")))
    out = rows.select("conv_id", "mid", F.explode(own).alias("t")).withColumn("t", normal(F.col("t"))).filter("t <> ''")
    return out.select("conv_id", "mid", F.xxhash64("t").alias("h")).distinct()


def _quoted(rows: DataFrame) -> DataFrame:
    """(conv_id, mid, level, passage, h, n): quoted lines, sentences and whole passages, with words."""
    lines = rows.filter(F.exists("lines", lambda x: x["level"] > 0))
    # a passage: neighbouring lines of one level; its number is the count of level changes before it
    passage = F.transform(
        "lines", lambda x, i: F.struct(x["level"].alias("level"), x["body"].alias("body"), F.when((i > 0) & (F.get("lines.level", i - 1) == x["level"]), 0).otherwise(1).alias("new"))
    )
    flat = lines.withColumn("lines", passage).select("conv_id", "mid", F.posexplode("lines").alias("i", "x"))
    number = F.sum("x.new").over(Window.partitionBy("conv_id", "mid").orderBy("i"))  # the lines of one message
    flat = flat.select("conv_id", "mid", "i", "x.level", number.alias("passage"), "x.body").filter("level > 0")
    # one message's passage: its lines, its sentences across them, and itself
    whole = flat.groupBy("conv_id", "mid", "level", "passage").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "body"))), lambda x: x["body"]).alias("bodies"))
    text = F.array_join("bodies", "\n")
    parts = F.concat("bodies", F.split(text, SENTENCE_END, -1), F.array(text))
    rows = whole.select("conv_id", "mid", "level", "passage", F.explode(parts).alias("t")).withColumn("t", normal(F.col("t"))).filter("t <> ''").distinct()
    return rows.select("conv_id", "mid", "level", "passage", F.xxhash64("t").alias("h"), F.size(F.split("t", " ")).alias("n"))


def links(rows: DataFrame, scratch: common.Scratch) -> DataFrame:
    """(conv_id, mid, parent, n_links): the message each quoting message replies to, ``n_links`` the
    number of its quoted lines, sentences and passages found, at any level."""
    quoted = scratch.write(_quoted(rows))
    wanted = quoted.select("conv_id", "h").distinct()
    same = lambda a, b: F.col(f"a.{a}").eqNullSafe(F.col(f"b.{b}"))
    originals = _hashes(rows).alias("a").join(wanted.alias("b"), same("conv_id", "conv_id") & (F.col("a.h") == F.col("b.h")), "left_semi")
    # of the messages holding a line only the latest before the quote counts: walk both in message order
    marks = originals.select("conv_id", "h", "mid", F.col("mid").alias("origin"), F.lit(0).alias("level"), F.lit(0).alias("passage"), F.lit(0).alias("n"))
    asks = quoted.select("conv_id", "h", "mid", F.lit(None).cast("long").alias("origin"), "level", "passage", "n")
    # (a message's questions come before its own lines in the order)
    found = _fill(scratch, marks.unionByName(asks), ["conv_id", "h", "mid", F.desc("level")], ["conv_id", "h"], "origin")
    found = found.withColumnRenamed("origin", "parent").filter("level > 0 AND parent IS NOT NULL")
    by = found.groupBy("conv_id", "mid", "level", "parent").agg(F.sum("n").alias("words"), F.count("*").alias("k"))
    best = by.groupBy("conv_id", "mid").agg(
        F.max_by("parent", F.struct(-F.col("level"), F.col("words"), F.col("parent"))).alias("parent"), F.sum("k").alias("n_links")
    )
    return best


def reply_order(messages: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turn, role, text, reply_to, n_links, depth, position`` per message: ``text``
    without quotes, ``reply_to`` and ``position`` counted in the conversation (turns may repeat),
    ``depth`` the branches between a message and the conversation's start."""
    scratch = common.Scratch(messages.sparkSession, "chat")
    slim = messages.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text")
    )
    keys = ["conv_id", "turn", "role", "text"]
    rows = _numbered(scratch, common.ordered(scratch, slim, keys), "mid")
    rows = scratch.write(parsed(rows))
    linked = scratch.write(links(rows, scratch))
    branches = _branches(scratch, linked.select("conv_id", F.col("mid").alias("start"), "parent").filter("parent <> start - 1"))
    same = lambda a, b: F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id"))
    joined = rows.select("conv_id", "turn", "role", F.col("own").alias("text"), "mid").alias("a")
    joined = joined.join(linked.alias("b"), same("a", "b") & (F.col("a.mid") == F.col("b.mid")), "left")
    joined = joined.join(branches.alias("c"), same("a", "c") & (F.col("a.mid") == F.col("c.start")), "left")
    joined = joined.select("a.*", "b.parent", "b.n_links", F.when(F.col("c.start").isNotNull(), F.struct("c.place", "c.depth")).alias("branch"))
    # a message belongs to the last branch that starts at or before it
    carried = _fill(scratch, joined, ["conv_id", "mid"], ["conv_id"], "branch")
    carried = carried.withColumn("place", F.coalesce("branch.place", F.lit(ROOT))).withColumn("depth", F.coalesce("branch.depth", F.lit(0)).cast("int"))
    final = common.ordered(scratch, carried.drop("branch"), ["conv_id", "place", "mid"])
    out = _numbered(scratch, final, "position")
    reply = F.coalesce(F.col("parent"), F.when(F.col("mid") > 0, F.col("mid") - 1))
    return out.select(
        "conv_id", "turn", "role", "text", reply.alias("reply_to"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        "depth", "position",
    )


def _numbered(scratch: common.Scratch, rows: DataFrame, name: str) -> DataFrame:
    """Place of every row in its conversation, from 0: its place in all rows less that of the first.

    A partition knows the first place of each conversation that starts in it; only the one it opens
    with may have started earlier, and that start is carried from the partitions before."""
    ends = (
        rows.groupBy("part").agg(F.count("*").alias("n"), F.min_by("conv_id", "row").alias("first"), F.max_by("conv_id", "row").alias("last"), F.max("row").alias("top"))
        .orderBy("part").collect()
    )  # one row per partition
    lasts = {  # place in the partition where its last conversation starts
        r["part"]: r["f"]
        for r in rows.join(F.broadcast(rows.groupBy("part").agg(F.max_by("conv_id", "row").alias("last"))), "part")
        .filter(F.col("conv_id").eqNullSafe(F.col("last"))).groupBy("part").agg(F.min("row").alias("f")).collect()
    }
    opened, open_key, open_at, run = {}, object(), 0, 0
    before = {}
    for r in ends:
        before[r["part"]] = run
        opened[r["part"]] = open_at - run if r["first"] == open_key else 0
        if not (r["first"] == r["last"] == open_key):
            open_key, open_at = r["last"], run + lasts[r["part"]]
        run += r["n"]
    firsts = {r["part"]: r["first"] for r in ends}
    rows = common.with_part_values(rows, {"_open": opened}) if ends else rows.withColumn("_open", F.lit(0))
    # the first row of a conversation inside one partition, as a running maximum over the partition
    start = F.last(F.when(~F.col("conv_id").eqNullSafe(F.col("_prev")) | (F.col("row") == 0), F.when(F.col("row") == 0, F.col("_open")).otherwise(F.col("row"))), True)
    by_row = Window.partitionBy("part").orderBy("row")  # one partition's rows
    rows = rows.withColumn("_prev", F.lag("conv_id").over(by_row))
    rows = rows.withColumn(name, (F.col("row") - start.over(by_row)).cast("long"))
    return rows.drop("_open", "_prev", "part", "row")


def _fill(scratch: common.Scratch, rows: DataFrame, keys: list, group: list[str], value: str) -> DataFrame:
    """The last non-null ``value`` of the same group at or before each row in the order of ``keys``.

    Inside a partition by a running last; across partitions the last value of the earlier ones is
    carried (one per partition), so a group may span any number of them."""
    rows = common.ordered(scratch, rows, keys)
    held_type = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("_x", T.StructType([rows.schema[c] for c in [*group, value]]))])
    last = rows.filter(F.col(value).isNotNull()).groupBy("part").agg(F.max_by(F.struct(*group, value), "row").alias("x")).collect()
    by_part, held, carried = {r["part"]: r["x"] for r in last}, None, []
    for p in sorted(r["part"] for r in rows.select("part").distinct().collect()):
        if held is not None:
            carried.append((p, held))
        held = by_part.get(p, held)
    rows = rows.join(F.broadcast(scratch.spark.createDataFrame(carried, held_type)), "part", "left")
    by_row = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    filled = F.coalesce(F.last(F.when(F.col(value).isNotNull(), F.struct(*group, value)), True).over(by_row), F.col("_x"))
    same = F.lit(True)
    for c in group:
        same = same & F.col(f"_filled.{c}").eqNullSafe(F.col(c))
    rows = rows.withColumn("_filled", filled)
    return rows.withColumn(value, F.when(F.col("_filled").isNotNull() & same, F.col(f"_filled.{value}"))).drop("_filled", "_x", "part", "row")


def _branches(scratch: common.Scratch, starts: DataFrame) -> DataFrame:
    """(conv_id, start, place, depth) per branch: ``place`` sorts the branches of a conversation in reply
    order, ``depth`` counts the branches around one, itself included.

    A branch is named by the message that opens it; the messages before the first one are branch 0, which
    no message with a parent can open.  The branches inside one come by the message they leave, the last
    first (the walk returns to it first), then by their start."""
    starts = scratch.write(starts)
    # the branch a parent lies in: the last start at or before it
    none = F.lit(None).cast("long")
    events = starts.select("conv_id", F.col("start").alias("at"), F.col("start").alias("branch"), none.alias("child"), none.alias("parent"))
    events = events.unionByName(starts.select("conv_id", F.col("parent").alias("at"), none.alias("branch"), F.col("start").alias("child"), "parent"))
    inside = _fill(scratch, events, ["conv_id", "at", F.col("branch").isNull(), "child"], ["conv_id"], "branch").filter("child IS NOT NULL")
    inside = scratch.write(inside.select("conv_id", F.col("child").alias("start"), "parent", F.coalesce("branch", F.lit(0)).alias("above")))
    # the next branch in the same one: the last before it in the opposite order (a question before its own mark)
    marks = inside.select("*", F.col("start").alias("next"), F.lit(1).alias("mark"))
    marks = marks.unionByName(inside.select("*", none.alias("next"), F.lit(0).alias("mark")))
    beside = _fill(scratch, marks, ["conv_id", "above", "parent", F.desc("start"), "mark"], ["conv_id", "above"], "next").filter("mark = 0")
    first = inside.groupBy("conv_id", "above").agg(F.min_by("start", F.struct(-F.col("parent"), F.col("start"))).alias("first"))
    tree = beside.select("conv_id", "start", "above", "next").unionByName(
        starts.select("conv_id").distinct().select("conv_id", F.lit(0).cast("long").alias("start"), none.alias("above"), none.alias("next"))
    )
    tree = tree.alias("a").join(first.alias("b"), F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.start") == F.col("b.above")), "left").select("a.*", "b.first")
    # the walk as a list: entering a branch is node 2 * start, leaving it 2 * start + 1
    enter = F.struct(
        (2 * F.col("start")).alias("node"), F.coalesce(2 * F.col("first"), 2 * F.col("start") + 1).alias("next"), F.lit(1).cast("long").alias("ahead"), F.lit(1).cast("long").alias("open")
    )
    leave = F.struct(
        (2 * F.col("start") + 1).alias("node"), F.coalesce(2 * F.col("next"), 2 * F.col("above") + 1).alias("next"), F.lit(0).cast("long").alias("ahead"), F.lit(-1).cast("long").alias("open")
    )
    walk = scratch.write(tree.select("conv_id", F.explode(F.array(enter, leave)).alias("x")).select("conv_id", "x.*"))
    while not walk.filter("next IS NOT NULL").isEmpty():
        # sums up to the node pointed at, and on from there
        step = walk.alias("a").join(walk.alias("b"), F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.next") == F.col("b.node")), "left")
        step = step.select("a.conv_id", "a.node", "b.next", *[(F.col(f"a.{c}") + F.coalesce(f"b.{c}", F.lit(0))).alias(c) for c in ("ahead", "open")])
        step = scratch.write(step)
        scratch.free(walk)
        walk = step
    # sums from a node to the end: branches still to enter, and less those open before it
    entered = walk.filter("node % 2 = 0 AND node > 0")
    return entered.select("conv_id", (F.col("node") / 2).cast("long").alias("start"), (-F.col("ahead")).alias("place"), (-F.col("open")).alias("depth"))

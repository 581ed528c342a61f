"""Line deduplication over a corpus by prefix doubling (operator 9); DataFrame functions only.

The sequence of a document is that of its lines that are not blank, each named by the hash of its
text without white space at the ends.  A run of lines is a later copy if the same run starts
earlier in the corpus (by doc_id, then place).  Lines lying in a later copy of at least ``MIN_WORDS``
words are deleted; the first copy stays.

Suffixes that agree on their first 2^k lines get the same name by prefix doubling: the name at level
k + 1 is the pair of the names at level k of a line and of the line 2^k further.  Suffixes of one
name are an LCP interval of the suffix array, and its first member is the copy that stays.  (Names
are hashes of pairs, not sorted ranks: which suffixes are equal is all that is asked, and a name
needs no global sort.)  Every maximal repeated run of at least ``MIN_WORDS`` words is the union of
shortest such runs that end or start at each of its lines; these hold at most ``MIN_WORDS`` lines, so
levels beyond ``MIN_WORDS`` lines are never needed and a run of any length is two overlapping names.

Scale: lines whose name occurs once are left out first; only hashes move, not texts; a line or run
that a third of all documents share is aggregated before the shuffle and joined back by broadcast of
the heaviest names, whose number is bounded.

Defined cases: null text stays null, with no lines; empty and blank lines are kept and never
counted; rows repeated with one doc_id and text are one document, both edited alike; a null doc_id
sorts first; a text may have any number of lines; an empty table gives an empty result; extra
columns are kept as they are (``n_lines`` and ``n_removed`` are replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemstats.llm import common

#: "Over 50 words."  Words of a line are its runs without white space, one at least.
MIN_WORDS = 51
WORD = r"[^\t\n\x0B\f\r \p{Z}]+"


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def _lines(docs: DataFrame) -> DataFrame:
    """(_id, _th, seq, pos, h, w) of every line that is not blank."""
    lines = F.filter(
        F.transform(F.split("_text", "\n", -1), lambda x, i: F.struct(i.alias("pos"), _trimmed(x).alias("t"))), lambda x: x["t"] != ""
    )
    out = docs.select("_id", "_th", F.posexplode(lines).alias("seq", "x"))
    words = F.greatest(F.lit(1), F.regexp_count("x.t", F.lit(WORD)))
    return out.select("_id", "_th", "seq", "x.pos", F.xxhash64("x.t").alias("h"), words.cast("long").alias("w"))


def _names(segments: DataFrame, words: int) -> DataFrame:
    """Per maximal stretch of repeated lines (arrays ``h``, ``w``, by place): names n0, n1, ... of the
    runs of 1, 2, 4, ... lines starting at each place; null where the stretch ends earlier."""
    out, k = segments.withColumn("n0", F.col("h")), 0
    while 2 << k <= words:
        out = out.withColumn(f"n{k + 1}", _doubled(F.col(f"n{k}"), 1 << k))
        k += 1
    return out


def _doubled(name: Column, step: int) -> Column:
    return F.transform(name, lambda x, i: F.when(F.get(name, i + step).isNotNull(), F.xxhash64(x, F.get(name, i + step))))


def _run_name(start: Column, length: Column, words: int) -> Column:
    """Name of a run: those of its first and last 2^k lines, which overlap and cover it."""
    name, k = F.lit(None).cast("long"), 0
    while 1 << k <= words:
        own = F.col(f"n{k}")
        name = F.when(length >= (1 << k), F.xxhash64(length, F.get(own, start), F.get(own, start + length - (1 << k)))).otherwise(name)
        k += 1
    return name


def _length(words: Column, least: int) -> Column:
    """Number of leading entries of an array with which its sum reaches ``least``; null if it doesn't."""
    zero = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).alias("n"))
    end = F.aggregate(
        words, zero, lambda a, x: F.when(a["sum"] >= least, a).otherwise(F.struct((a["sum"] + x).alias("sum"), (a["n"] + 1).alias("n")))
    )
    return F.when(end["sum"] >= least, end["n"])


def _repeated(scratch: common.Scratch, rows: DataFrame, key: str, place: list[str]) -> DataFrame:
    """``rows`` whose ``key`` stands at more than one place, with the first one as ``first``."""
    at = F.struct(*place)
    keyed = rows.groupBy(key).agg(F.min(at).alias("first"), F.max(at).alias("last"), F.count("*").alias("n"))
    keyed = scratch.write(keyed.filter(F.col("first") != F.col("last")).drop("last"))
    return common.join_keyed(rows, keyed, key, "n", rows.count()).filter("first is not null")


def later_copies(scratch: common.Scratch, docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(_id, _th, _deleted: sorted line numbers) of every document that holds later copies.

    ``docs``: _id, _th (hash of the text), _text."""
    lines = scratch.write(_lines(docs))
    shared = _repeated(scratch, lines, "h", ["_id", "_th", "seq"]).select("_id", "_th", "seq", "pos", "h", "w").distinct()
    whole = shared.groupBy("_id", "_th").agg(F.array_sort(F.collect_list(F.struct("seq", "pos", "h", "w"))).alias("x"))  # lines of one text
    # stretches of neighbouring lines: seq less the index is constant within one
    split = whole.select("_id", "_th", F.posexplode("x").alias("i", "x")).select("_id", "_th", (F.col("x.seq") - F.col("i")).alias("stretch"), "x")
    split = split.groupBy("_id", "_th", "stretch").agg(F.array_sort(F.collect_list("x")).alias("x"))
    split = split.select("_id", "_th", F.col("x")[0]["seq"].alias("from"), F.col("x.pos").alias("pos"), F.col("x.h").alias("h"), F.col("x.w").alias("w"))
    split = split.filter(F.aggregate("w", F.lit(0).cast("long"), lambda a, x: a + x) >= min_words)
    named = _names(scratch.write(split), min_words)
    size, w = F.size("w"), F.col("w")
    forward = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(i.alias("start"), _length(F.slice(w, i + 1, min_words), min_words).alias("length")))
    back = F.reverse(w)
    backward = F.transform(
        F.sequence(F.lit(0), size - 1), lambda i: F.struct(i.alias("end"), _length(F.slice(back, size - i, min_words), min_words).alias("length"))
    )
    backward = F.transform(backward, lambda x: F.struct((x["end"] - x["length"] + 1).alias("start"), x["length"].alias("length")))
    runs = F.array_distinct(F.filter(F.concat(forward, backward), lambda x: x["length"].isNotNull()))
    named = named.withColumn("runs", runs).withColumn("r", F.explode("runs"))
    found = named.select(
        "_id", "_th", (F.col("from") + F.col("r.start")).alias("seq"), F.slice("pos", F.col("r.start") + 1, F.col("r.length")).alias("pos"),
        _run_name(F.col("r.start"), F.col("r.length"), min_words).alias("name"),
    )
    found = scratch.write(found)
    copies = _repeated(scratch, found, "name", ["_id", "_th", "seq"]).filter(~F.col("first").eqNullSafe(F.struct("_id", "_th", "seq")))
    marked = copies.select("_id", "_th", F.explode("pos").alias("pos")).groupBy("_id", "_th")
    return marked.agg(F.array_sort(F.collect_set("pos")).alias("_deleted"))


def dedup(docs: DataFrame, min_words: int = MIN_WORDS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with later copies deleted from ``text``, and ``n_lines``, ``n_removed`` (not blank)."""
    scratch = common.Scratch(docs.sparkSession, "lines")
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    # the row is one column, so no name of its columns can clash
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    text_of = F.col("row")[text].cast("string")
    own = own.withColumn("_id", F.col("row")[doc_id].cast("long")).withColumn("_th", F.xxhash64(text_of))
    gone = scratch.write(later_copies(scratch, own.select("_id", "_th", text_of.alias("_text")), min_words))
    gone = gone.select(F.col("_id").alias("_i"), F.col("_th").alias("_t"), "_deleted")
    # only documents that may be edited are joined; the others' texts are not shuffled
    own = common.likely(own, F.xxhash64("_id", "_th"), gone.select(F.xxhash64("_i", "_t").alias("key")))
    edited = own.filter("_likely").join(gone.hint("merge"), F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_th") == F.col("_t")), "left")
    out = edited.drop("_i", "_t").unionByName(own.filter("NOT _likely").withColumn("_deleted", F.lit(None).cast("array<int>")))
    out = out.withColumn("_lines", F.split(text_of, "\n", -1))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_deleted"), lambda i: F.get(F.col("_lines"), i))
    count = F.size(F.filter("_lines", lambda x: _trimmed(x) != ""))
    edited_text = F.when(F.col("_deleted").isNull(), F.col("row")[text]).otherwise(F.array_join(kept, "\n"))
    return out.select(
        *[(edited_text if c == text else F.col("row")[c]).alias(c) for c in names],
        F.when(text_of.isNull(), 0).otherwise(count).alias("n_lines"),
        F.when(F.col("_deleted").isNull(), 0).otherwise(F.size("_deleted")).alias("n_removed"),
    )


ORACLE = f"""
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM split),
own AS (SELECT doc_id, pos, trim(line, ' ' || chr(9) || chr(13)) AS t,
  row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS seq
  FROM lines WHERE trim(line, ' ' || chr(9) || chr(13)) <> ''),
pairs AS (SELECT a.doc_id AS da, b.doc_id AS db, a.seq AS sa, a.pos AS pa, a.seq - b.seq AS shift,
  greatest(1, len(regexp_extract_all(a.t, '{WORD}'))) AS w
  FROM own a JOIN own b ON a.t = b.t AND (b.doc_id < a.doc_id OR (b.doc_id = a.doc_id AND b.seq < a.seq))),
islands AS (SELECT *, sa - row_number() OVER (PARTITION BY da, db, shift ORDER BY sa) AS island FROM pairs),
gone AS (SELECT DISTINCT da, pa FROM (
  SELECT da, pa, sum(w) OVER (PARTITION BY da, db, shift, island) AS words FROM islands) WHERE words >= {MIN_WORDS}),
kept AS (SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) AS text
  FROM lines l LEFT JOIN gone g ON g.da = l.doc_id AND g.pa = l.pos WHERE g.da IS NULL GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
  CAST((SELECT count(*) FROM own o WHERE o.doc_id = d.doc_id) AS INTEGER) AS n_lines,
  CAST((SELECT count(*) FROM gone g WHERE g.da = d.doc_id) AS INTEGER) AS n_removed
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

"""A training-data pipeline over ``documents``: each stage works on all that its predecessor kept.

A stage is ``(spark, docs, sf_dir) -> DataFrame``; ``run`` writes every stage's result as Parquet to
the shared checkpoint folder and reads it again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemstats.llm import decontamination, language_id, line_dedup, ngram_join, packing
from itemstats.llm.common import Scratch, join_keyed, likely, table

#: Languages wanted; None: all that the labelled rows hold.
WANTED: tuple[str, ...] | None = None
#: A document is rejected when the wanted languages together hold less than this share of it.
MIN_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in wanted languages: without a letter, or with under half in all wanted languages together,
    they go, also where the rest is in a language of no labelled row.  Where no labelled row is learnt from,
    no language is known and rows with a letter stay."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    langs, model = language_id.train(docs, "text", "lang", ~held_out, F.col("doc_id"))
    if not langs:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    own = [F.struct(*docs.columns).alias("row")]
    judged = language_id.predict(docs, langs, model, "text", own, wanted=langs if WANTED is None else WANTED)
    return judged.filter((F.col("languages") != "") & (F.col("share") >= MIN_SCORE)).select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of over 50 words are deleted; documents of which nothing is left go."""
    out = line_dedup.dedup(docs).filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    edited = F.col("n_removed") > 0
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(edited, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that with the smallest doc_id (null last), of equal
    ones that whose text has the smallest key.  A row goes only for a row linked to it, whatever their ids;
    of rows with one doc_id and text one stays.  Rows without words link with nothing and stay."""
    scratch = Scratch(spark, "classes")
    rows = scratch.write(ngram_join.join(docs).select("doc_id", "text_key", "component").filter("component IS NOT NULL"))
    own = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")
    groups = rows.groupBy("component").agg(F.min(own).alias("stays"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    judged = join_keyed(rows, scratch.write(groups), "component", "n", rows.count()).filter("stays IS NOT NULL")
    judged = judged.groupBy("doc_id", "text_key").agg(F.bool_or(own == F.col("stays")).alias("stays"), F.count(F.lit(1)).alias("n"))
    judged = scratch.write(judged.filter("NOT stays OR n > 1").select(F.col("doc_id").alias("id"), F.col("text_key").alias("of"), "stays"))
    # the row is one column, so no name of its columns can clash; rows that surely stay are not shuffled
    all_rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    all_rows = all_rows.withColumn("doc_id", F.col("row.doc_id").cast("long")).withColumn("text_key", ngram_join.text_key(F.col("row.text")))
    marked = likely(all_rows, F.xxhash64("doc_id", "text_key"), judged.select(F.xxhash64("id", "of").alias("key")))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("of"))
    met = marked.filter("_likely").join(judged.hint("merge"), same, "left")
    alone = met.filter("of IS NULL").unionByName(marked.filter("NOT _likely"), allowMissingColumns=True).select("row.*")
    repeated = met.filter("stays").groupBy("doc_id", "text_key").agg(F.first("row").alias("row"))
    return alone.unionByName(repeated.select("row.*"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item with ``MIN_EQUAL`` or more equal words: a
    shorter overlap, such as an item of a few common words, removes nothing."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"), least=decontamination.MIN_EQUAL)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces of token sequences, with the ids of each piece."""
    return packing.pack(docs, with_ids=True)


STAGES = [
    ("language ID", language),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("best-fit packing", packed),
]
#: Language models and tokens are not expressible in SQL; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir))
    return docs

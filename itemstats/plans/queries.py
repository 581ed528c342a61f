"""The registered queries: each reads the driver's tables under ``sf_dir``,
derives the exam fixture and runs one operator of the library on it.

Doubles are rounded to 6 decimals for the comparison with the oracle SQL
(:mod:`itemstats.plans.oracle`); the library itself returns unrounded values.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemstats import defaults
from itemstats.functions.sizing import stored
from itemstats.functions.students import code_parts, join_code
from itemstats.operators import clusters, discretize, growing, item_stats, knowledge, paper_stats, reshape, rules, totals
from itemstats.schema import BATCH_KEYS, STUDENT_KEYS
from itemstats.session import ensure_checkpoint_dir
from itemstats.sinks import results as result_sinks
from itemstats.sinks import store as result_store
from itemstats.sources import batches, fixture, responses as json_source, tables

Query = Callable[[SparkSession, str], DataFrame]


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (for engine-independent comparison)."""
    return df.select(
        *[
            F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Answer sheets (stored: every branch of a query reads them) and blueprint items."""
    responses = fixture.responses(spark, sf_dir)
    items = reshape.blueprint_items(fixture.blueprint(spark, sf_dir))
    ensure_checkpoint_dir(spark)
    return stored(reshape.answer_sheets(responses)), items


def q_total_score(mode: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sheets, items = _inputs(spark, sf_dir)
        return totals.score_totals(sheets, items, mode)

    return run


def q_high_low_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheets, items = _inputs(spark, sf_dir)
    g = totals.high_low_groups(totals.total_score(sheets, items))
    return g.select(*STUDENT_KEYS, "total_score", "is_high", "is_low")


def q_group_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheets, items = _inputs(spark, sf_dir)
    return totals.group_sizes(totals.total_score(sheets, items))


def q_item_index(mode: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sheets, items = _inputs(spark, sf_dir)
        return round_doubles(item_stats.compute(sheets, items, mode))

    return run


def q_paper_index(mode: str, rounded: bool = False) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sheets, items = _inputs(spark, sf_dir)
        t = totals.total_score(sheets, items, mode)
        grouped = totals.high_low_groups(t)
        ii = item_stats.from_groups(grouped, items)
        return round_doubles(paper_stats.compute(t, ii, items, rounded=rounded))

    return run


def _grown(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Item and paper statistics after the sheets arrived in three deltas, the second of them twice."""
    sheets, items = _inputs(spark, sf_dir)
    state = f"{ensure_checkpoint_dir(spark)}/growing-{uuid.uuid4().hex}"
    part = F.pmod(F.crc32("stu_code"), F.lit(3))
    for epoch in (0, 1, 1, 2):
        growing.add(sheets.filter(part == epoch), items, state, epoch)
    return growing.statistics(spark, state, items)


def q_item_index_grown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(_grown(spark, sf_dir)[0])


def q_paper_index_grown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(_grown(spark, sf_dir)[1])


# Parameters of the registered rule queries.  At the reference's thresholds
# (0.6 / 0.65 support, 0.85 confidence) the fixture has few or no rules, so the
# checks run lower ones; the library defaults stay the reference's.
ITEM_RULE_SUPPORT, ITEM_RULE_CONFIDENCE = 0.3, 0.6
KL_RULE_SUPPORT, KL_RULE_CONFIDENCE = 0.45, 0.85
ITEMSET_SUPPORT = 0.3
# Extreme-item thresholds that remove items from this fixture (its difficulties lie in 0.40-0.74).
EXTREME_LO, EXTREME_HI = 0.45, 0.7


def _json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture written as the reference's JSON lines, materialised like landed files."""
    ensure_checkpoint_dir(spark)
    return stored(fixture.as_json_lines(fixture.responses(spark, sf_dir)))


def q_responses_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture -> the reference's nested JSON lines -> parsed back to the long table."""
    return json_source.to_long(_json_lines(spark, sf_dir), create_time=F.col("create_time"))


def q_json_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture -> JSON lines -> answer sheets in one pass, shown as (sample, item, score) rows."""
    sheets = json_source.to_sheets(_json_lines(spark, sf_dir), create_time=F.col("create_time"))
    return sheets.select(*STUDENT_KEYS, F.explode("cells").alias("item_id", "score"))


def q_json_fractional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half marks through the JSON lines: every score is halved before it is written."""
    halves = fixture.responses(spark, sf_dir).withColumn("score", F.col("score") / 2.0)
    return json_source.to_long(stored(fixture.as_json_lines(halves)), create_time=F.col("create_time"), score_type="double")


def q_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the parser cannot use, on lines spoilt by the last digit of the student code: 3 has no
    opening brace, 5 no stuCode, 7 an unreadable first score, 9 another paper than its folder."""
    digit = F.regexp_extract("value", r'"stuCode":"\d*(\d)"', 1)
    value = (
        F.when(digit == "3", F.substr("value", F.lit(2)))
        .when(digit == "5", F.replace("value", F.lit('"stuCode"'), F.lit('"code"')))
        .when(digit == "7", F.regexp_replace("value", r'"i1":\d+', '"i1":"?"'))
        .otherwise(F.col("value"))
    )
    paper = F.when(digit == "9", F.lit("elsewhere")).otherwise(F.regexp_extract("value", r'"paperCode":"([^"]*)"', 1))
    lines = _json_lines(spark, sf_dir).select("create_time", value.alias("value"), paper.alias("folder"))
    return json_source.rejected(lines, create_time=F.col("create_time"), paper_code=F.col("folder"))


def q_result_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item statistics written twice as a result and read back."""
    sheets, items, ii = _item_index(spark, sf_dir)
    target = f"{ensure_checkpoint_dir(spark)}/round-trip-{uuid.uuid4().hex}/t_item_index"
    for _ in range(2):
        result_sinks.write_result(ii, target, analysed=reshape.batches(sheets))
    return round_doubles(result_sinks.read_result(spark, target))


def q_results_at_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item and paper statistics committed together twice, first in zero mode, and the items read back."""
    sheets, items = _inputs(spark, sf_dir)
    target = f"{ensure_checkpoint_dir(spark)}/at-once-{uuid.uuid4().hex}"
    for mode in ("zero", "propagate"):
        grouped = stored(totals.high_low_groups(totals.total_score(sheets, items, mode)))
        ii = stored(item_stats.from_groups(grouped, items))
        result_store.commit({"t_item_index": ii, "t_paper_index": paper_stats.compute(grouped, ii, items)}, target, reshape.batches(sheets))
    return round_doubles(result_store.read(spark, target, "t_item_index"))


def q_blueprint_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    bp = tables.wide_blueprint(fixture.wide_paper_item(spark, sf_dir))
    return reshape.blueprint_items(bp)


def q_responses_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheets, items = _inputs(spark, sf_dir)
    return reshape.complete(sheets, items)


def q_responses_marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = reshape.blueprint_items(fixture.blueprint(spark, sf_dir))
    return reshape.attach_marks(fixture.responses(spark, sf_dir), items)


def q_select_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, requests = fixture.batch_requests(spark, sf_dir)
    return batches.select_batch(batches.batch_files(files), requests)


def q_item_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheets, items = _inputs(spark, sf_dir)
    return discretize.item_labels(sheets, items)


def _item_index(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    sheets, items = _inputs(spark, sf_dir)
    return sheets, items, item_stats.compute(sheets, items)


def q_extreme_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, ii = _item_index(spark, sf_dir)
    return round_doubles(discretize.extreme_items(ii, EXTREME_LO, EXTREME_HI))


def q_kept_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, ii = _item_index(spark, sf_dir)
    return discretize.kept_items(ii, EXTREME_LO, EXTREME_HI)


def _kl(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    sheets, items = _inputs(spark, sf_dir)
    ik = tables.read_item_knowledge(spark, fixture.item_knowledge(spark, sf_dir))
    return sheets, items, ik


def q_knowledge_full_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = reshape.blueprint_items(fixture.blueprint(spark, sf_dir))
    ik = tables.read_item_knowledge(spark, fixture.item_knowledge(spark, sf_dir))
    fm = knowledge.full_marks(ik, items)
    return fm.select("paper_code", "kl_id", F.array_join("kl_items", ",").alias("kl_items"), "full_mark")


def q_knowledge_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheets, items, ik = _kl(spark, sf_dir)
    return knowledge.scores(sheets, ik, items)


def q_knowledge_scores_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheets, items, ik = _kl(spark, sf_dir)
    return knowledge.scores(sheets, ik, items, missing="zero")


def q_knowledge_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheets, items, ik = _kl(spark, sf_dir)
    return knowledge.labels(knowledge.scores(sheets, ik, items))


def q_item_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheets, items = _inputs(spark, sf_dir)
    return rules.transactions_text(discretize.item_transactions(sheets, items))


def q_knowledge_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheets, items, ik = _kl(spark, sf_dir)
    return rules.transactions_text(knowledge.transactions(sheets, ik, items))


def q_frequent_itemsets_le3(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheets, items = _inputs(spark, sf_dir)
    sets = rules.frequent_itemsets(discretize.item_transactions(sheets, items), ITEMSET_SUPPORT)
    return sets.filter(F.size("items") <= 3).select(*BATCH_KEYS, F.array_join("items", ",").alias("items"), "freq")


def q_frequent_itemsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheets, items = _inputs(spark, sf_dir)
    sets = rules.frequent_itemsets(discretize.item_transactions(sheets, items), ITEMSET_SUPPORT)
    return sets.select(*BATCH_KEYS, F.array_join("items", ",").alias("items"), "freq")


def _rule_rows(r: DataFrame) -> DataFrame:
    return round_doubles(
        r.select(
            *BATCH_KEYS,
            F.array_join("antecedent", ",").alias("antecedent"),
            "consequent",
            "confidence",
            "support",
            "lift",
        )
    )


def _item_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheets, items, ii = _item_index(spark, sf_dir)
    return rules.item_rules(sheets, items, ii, ITEM_RULE_SUPPORT, ITEM_RULE_CONFIDENCE)


def _knowledge_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheets, items, ik = _kl(spark, sf_dir)
    return rules.knowledge_rules(sheets, ik, items, KL_RULE_SUPPORT, KL_RULE_CONFIDENCE)


def q_item_rules_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rule_rows(_item_rules(spark, sf_dir).filter(F.size("antecedent") == 1))


def q_knowledge_rules_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rule_rows(_knowledge_rules(spark, sf_dir).filter(F.size("antecedent") == 1))


def q_knowledge_rules_1_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-item knowledge rules under the reference's text comparison of ids."""
    sheets, items, ik = _kl(spark, sf_dir)
    r = rules.knowledge_rules(sheets, ik, items, KL_RULE_SUPPORT, KL_RULE_CONFIDENCE, compare="string")
    return _rule_rows(r.filter(F.size("antecedent") == 1))


def q_incomplete_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheets, items = _inputs(spark, sf_dir)
    return clusters.incomplete(sheets, items)


def q_latest_attempt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.latest_attempt(fixture.responses(spark, sf_dir))


def q_item_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rule_rows(_item_rules(spark, sf_dir))


def q_knowledge_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rule_rows(_knowledge_rules(spark, sf_dir))


def q_knowledge_rules_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Knowledge rules of any size under the reference's text comparison of ids."""
    sheets, items, ik = _kl(spark, sf_dir)
    return _rule_rows(rules.knowledge_rules(sheets, ik, items, KL_RULE_SUPPORT, KL_RULE_CONFIDENCE, compare="string"))


def q_item_fpg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item rules in the reference's ``t_item_fpg`` shape."""
    return round_doubles(rules.format_rules(_item_rules(spark, sf_dir)))


def q_knowledge_fpg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Knowledge rules in the reference's ``t_item_fpg`` shape."""
    return round_doubles(rules.format_rules(_knowledge_rules(spark, sf_dir)))


def q_student_code_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheets, _ = _inputs(spark, sf_dir)
    p = code_parts(sheets.select(*STUDENT_KEYS))
    return p.withColumn("rebuilt", join_code(F.col("gc"), F.col("mc"), F.col("cc"), F.col("nc")))


def q_cluster_profile_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheets, items = _inputs(spark, sf_dir)
    banded = clusters.score_bands(clusters.features(sheets, items), defaults.K)
    return clusters.profile(banded, items)


def q_cluster_nearest_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheets, items = _inputs(spark, sf_dir)
    feats = clusters.features(sheets, items)
    cents = clusters.centroids(clusters.score_bands(feats, defaults.K))
    return clusters.assign(feats, cents, digits=9).select(*STUDENT_KEYS, "cluster")


def q_cluster_centers_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheets, items = _inputs(spark, sf_dir)
    banded = clusters.score_bands(clusters.features(sheets, items), defaults.K)
    return round_doubles(clusters.centers_by_item(banded, items))


def q_item_index_narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item statistics in the reference's decimal(4,3) columns; a variance of 10 or more is null."""
    sheets, items = _inputs(spark, sf_dir)
    narrow = result_sinks.narrow(item_stats.compute(sheets, items), "t_item_index")
    # shown as doubles so both engines print the same values
    return narrow.select(
        *[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
          for f in narrow.schema.fields]
    )


def _cluster_rows(cents: DataFrame) -> DataFrame:
    """Centres as one row per vector position, for comparison."""
    return round_doubles(cents.select(*BATCH_KEYS, "cluster", F.posexplode("center").alias("pos", "x")))


def q_kmeans_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheets, items = _inputs(spark, sf_dir)
    return _cluster_rows(clusters.seeds(stored(clusters.features(sheets, items))))


def q_kmeans_parallel_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheets, items = _inputs(spark, sf_dir)
    return _cluster_rows(clusters.parallel_seeds(stored(clusters.features(sheets, items))))


def q_kmeans_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three Lloyd steps from the seeds."""
    sheets, items = _inputs(spark, sf_dir)
    return _cluster_rows(clusters.fit(stored(clusters.features(sheets, items)), max_iter=3, tol=-1.0))


def q_clusters_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of clusters and their sizes per batch."""
    sheets, items = _inputs(spark, sf_dir)
    s = clusters.summary(clusters.score_bands(clusters.features(sheets, items), defaults.K))
    return s.select(*BATCH_KEYS, "clusters", F.array_join(F.transform("sizes", lambda x: x["size"].cast("string")), ",").alias("sizes"))


def q_student_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheets, items = _inputs(spark, sf_dir)
    prof, _ = clusters.run(sheets, items)
    return prof


def registry() -> dict[str, Query]:
    return {
        "total_score_propagate": q_total_score("propagate"),
        "total_score_zero": q_total_score("zero"),
        "group_sizes": q_group_sizes,
        "high_low_groups": q_high_low_groups,
        "item_index": q_item_index("propagate"),
        "item_index_zero": q_item_index("zero"),
        "paper_index": q_paper_index("propagate"),
        "paper_index_zero": q_paper_index("zero"),
        "paper_index_rounded": q_paper_index("propagate", rounded=True),
        "item_index_grown": q_item_index_grown,
        "paper_index_grown": q_paper_index_grown,
        "responses_long": q_responses_long,
        "json_sheets": q_json_sheets,
        "json_fractional": q_json_fractional,
        "rejected": q_rejected,
        "result_round_trip": q_result_round_trip,
        "results_at_once": q_results_at_once,
        "blueprint_items": q_blueprint_items,
        "responses_complete": q_responses_complete,
        "responses_marked": q_responses_marked,
        "select_batch": q_select_batch,
        "item_labels": q_item_labels,
        "extreme_items": q_extreme_items,
        "kept_items": q_kept_items,
        "knowledge_full_marks": q_knowledge_full_marks,
        "knowledge_scores": q_knowledge_scores,
        "knowledge_scores_zero": q_knowledge_scores_zero,
        "knowledge_labels": q_knowledge_labels,
        "item_transactions": q_item_transactions,
        "knowledge_transactions": q_knowledge_transactions,
        "frequent_itemsets_le3": q_frequent_itemsets_le3,
        "frequent_itemsets": q_frequent_itemsets,
        "item_rules_1": q_item_rules_1,
        "knowledge_rules_1": q_knowledge_rules_1,
        "knowledge_rules_1_text": q_knowledge_rules_1_text,
        "incomplete_sheets": q_incomplete_sheets,
        "latest_attempt": q_latest_attempt,
        "item_rules": q_item_rules,
        "knowledge_rules": q_knowledge_rules,
        "knowledge_rules_text": q_knowledge_rules_text,
        "item_fpg": q_item_fpg,
        "knowledge_fpg": q_knowledge_fpg,
        "student_code_parts": q_student_code_parts,
        "cluster_profile_given": q_cluster_profile_given,
        "cluster_nearest_given": q_cluster_nearest_given,
        "cluster_centers_given": q_cluster_centers_given,
        "item_index_narrow": q_item_index_narrow,
        "kmeans_seeds": q_kmeans_seeds,
        "kmeans_parallel_seeds": q_kmeans_parallel_seeds,
        "kmeans_steps": q_kmeans_steps,
        "clusters_summary": q_clusters_summary,
        "student_clusters": q_student_clusters,
    }

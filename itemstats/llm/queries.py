"""The registered queries of the operators, with production parameters over whole tables, and
their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from itemstats.llm import (
    decontamination,
    divergence,
    embeddings,
    html_text,
    language_id,
    lexical_search,
    line_dedup,
    ngram_join,
    packing,
    quotations,
    secrets,
    sharding,
    url_filter,
)
from itemstats.llm.common import table


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents")).drop("text_key", "component")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find(table(spark, sf_dir, "documents"))


def op4_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotations.reply_order(table(spark, sf_dir, "conversations"))


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.rule_table(spark, url_filter.RULES))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
        "op2_html_extraction": op2_html_extraction,
        "op3_secret_scan": op3_secret_scan,
        "op4_quotation_linking": op4_quotation_linking,
        "op5_embedding_near_dedup": op5_embedding_near_dedup,
        "op6_benchmark_decontamination": op6_benchmark_decontamination,
        "op7_best_fit_packing": op7_best_fit_packing,
        "op8_language_id": op8_language_id,
        "op9_line_dedup": op9_line_dedup,
        "op10_sharding": op10_sharding,
        "op11_url_filters": op11_url_filters,
        "op12_source_divergence": op12_source_divergence,
        "op13_ranked_lexical_search": op13_ranked_lexical_search,
    }


def oracles() -> dict[str, str]:
    return {
        "op9_line_dedup": line_dedup.ORACLE,
        "op11_url_filters": url_filter.ORACLE,
        "op12_source_divergence": divergence.ORACLE,
        "op13_ranked_lexical_search": lexical_search.ORACLE,
    }

"""The dealt operators as queries over the whole tables of a directory, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabloom.llm import chat, collocations, decontaminate, exact_dedup, html_text, jaccard, language_model, licenses, personal_data, pieces, prefix_trie, quality, url_filter
from tabloom.sources.tables import Tables


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(Tables(spark, sf_dir).pages)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_texts(Tables(spark, sf_dir).documents)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Tables(spark, sf_dir)
    return quality.judge_quality(tables.documents, tables.labels).select("doc_id", "_quality.*")


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(Tables(spark, sf_dir).documents).select("doc_id", "n_shingles", "component_id")


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(Tables(spark, sf_dir).pages)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(Tables(spark, sf_dir).documents, digest_all=True)


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Tables(spark, sf_dir)
    return decontaminate.contamination(tables.documents, tables.benchmark).drop("spans")


def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = licenses.scan_licenses(Tables(spark, sf_dir).documents)
    return rows.withColumn("line_licenses", F.concat_ws(",", "line_licenses"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_digests(Tables(spark, sf_dir).documents)


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("order_key")
    rows = chat.format_chat(Tables(spark, sf_dir).conversations)
    return rows.select("conv_id", "turn", "role", key["turn"].alias("order_turn"), key["place"].alias("order_place"), "json", "n_calls", "argument_errors", "link")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    return prefix_trie.prefix_trie(Tables(spark, sf_dir).conversations)


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document, plain and disguised."""
    return personal_data.find_personal_data(Tables(spark, sf_dir).documents)


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 strongest phrases of every language."""
    return collocations.collocations(Tables(spark, sf_dir).documents)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_html_extraction, op2_lm_scoring, op3_quality_classifier, op4_ngram_jaccard_join, op5_url_filters,
        op6_exact_dedup, op7_benchmark_decontamination, op8_license_scans, op9_sentencepiece, op10_chat_formatting,
        op11_prefix_trie, op12_pii, op13_phrase_collocations,
    )
}
CHECKS: dict[str, str] = {
    "op4_ngram_jaccard_join": jaccard.SQL,
    "op5_url_filters": url_filter.SQL,
    "op6_exact_dedup": exact_dedup.SQL,
    "op7_benchmark_decontamination": decontaminate.SQL,
    "op8_license_scans": licenses.SQL,
    "op11_prefix_trie": prefix_trie.SQL,
    "op13_phrase_collocations": collocations.SQL,
}

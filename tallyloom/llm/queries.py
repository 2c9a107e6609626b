"""Every operator of this folder as a query over the tables in a folder, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm.common import table
from tallyloom.llm.conversations import repair
from tallyloom.llm.decontamination import find_leaks
from tallyloom.llm.jaccard_join import jaccard_classes
from tallyloom.llm.license_scan import license_scan
from tallyloom.llm.main_text import extract_pages
from tallyloom.llm.packing import pack_documents
from tallyloom.llm.personal_data import personal_data
from tallyloom.llm.quality_classifier import quality_scores
from tallyloom.llm.quality_rules import quality_rules
from tallyloom.llm.resampling import resample
from tallyloom.llm.span_dedup import span_digest
from tallyloom.llm.token_counts import token_counts
from tallyloom.llm.url_filters import Rule, judge_urls

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
URL_RULES = [Rule.parse("net/", "block"), Rule.parse("example.net/en/", "allow"), Rule.parse("example.com/de/", "block"), Rule.parse("org/fr/", "allow")]


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op2_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return span_digest(table(spark, folder, "documents"))


def op3_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract_pages(table(spark, folder, "pages"))


def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"), WORD_BPE)


def op6_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(table(spark, folder, "pages"), URL_RULES)


def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_classes(table(spark, folder, "documents")).drop("text_hash")


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), WORD_BPE)


def op9_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan(table(spark, folder, "documents"))


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules(table(spark, folder, "documents"))


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair(table(spark, folder, "conversations"))


def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_suffix_array_dedup,
        op3_benchmark_decontamination,
        op4_html_extraction,
        op5_best_fit_packing,
        op6_url_filters,
        op7_jaccard_join,
        op8_token_counts,
        op9_license_scans,
        op10_quality_rules,
        op11_conversation_repair,
        op12_importance_resampling,
        op13_personal_data,
    )
}

"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parcelstar.llm import (
    chat_format,
    decontamination,
    html_extraction,
    jaccard_join,
    language_model,
    license_scan,
    line_dedup,
    merkle_manifest,
    packing,
    quality_rules,
    ranked_search,
    sharding,
    token_counts,
)
from parcelstar.llm.workers import prepare


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.op1_decontamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.op2_quality_rules(_table(spark, sf_dir, "documents"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.op5_chat_format(_table(spark, sf_dir, "conversations"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.op6_token_counts(_table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.op7_best_fit_packing(_table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.op8_sharding(_table(spark, sf_dir, "documents"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.op4_ngram_jaccard_join(_table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.op9_license_scan(_table(spark, sf_dir, "documents"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.op10_lm_scoring(_table(spark, sf_dir, "documents"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.op11_line_dedup(_table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.op12_merkle_manifest(_table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.op13_ranked_search(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.op3_html_extraction(_table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_quality_rules": op2_quality_rules,
    "op3_html_extraction": op3_html_extraction,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_chat_format": op5_chat_format,
    "op6_token_counts": op6_token_counts,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_sharding": op8_sharding,
    "op9_license_scan": op9_license_scan,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_line_dedup": op11_line_dedup,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_ranked_search": op13_ranked_search,
}

ORACLES: dict[str, str] = {
    "op1_decontamination": decontamination.ORACLE,
    "op2_quality_rules": quality_rules.ORACLE,
    "op5_chat_format": chat_format.ORACLE,
    "op11_line_dedup": line_dedup.ORACLE,
    "op12_merkle_manifest": merkle_manifest.ORACLE,
    "op13_ranked_search": ranked_search.ORACLE,
}

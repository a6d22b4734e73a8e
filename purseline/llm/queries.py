"""The queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from purseline.llm import (
    codes,
    decontaminate,
    jaccard,
    language,
    licenses,
    lm,
    manifest,
    mixing,
    quality,
    secrets,
    sharding,
    substrings,
    warc,
)
from purseline.llm.common import table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeats_report(table(spark, sf_dir, "documents"))


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_report(table(spark, sf_dir, "documents"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets_report(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_report(table(spark, sf_dir, "pages"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_report(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharding_report(table(spark, sf_dir, "documents"))


def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(table(spark, sf_dir, "documents"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest_report(table(spark, sf_dir, "documents"))


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_report(table(spark, sf_dir, "documents"))


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compression_report(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_secrets": op2_secrets,
    "op3_quality": op3_quality,
    "op4_lm": op4_lm,
    "op5_licenses": op5_licenses,
    "op6_mixing": op6_mixing,
    "op7_substrings": op7_substrings,
    "op8_jaccard": op8_jaccard,
    "op9_warc": op9_warc,
    "op10_sharding": op10_sharding,
    "op11_manifest": op11_manifest,
    "op12_language": op12_language,
    "op13_codes": op13_codes,
}

SQL: dict[str, str] = {
    "op1_decontaminate": decontaminate.SQL,
    "op7_substrings": substrings.SQL,
    "op8_jaccard": jaccard.SQL,
    "op9_warc": warc.SQL,
    "op11_manifest": manifest.SQL,
    "op13_codes": codes.SQL,
}

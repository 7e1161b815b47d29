"""The registered corpus queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from airshed.llm import (
    decontaminate,
    embed_dedup,
    html_extract,
    langid,
    manifest,
    ngram_join,
    packing,
    pii,
    prefix_trie,
    quality,
    secrets,
    sharding,
    url_filter,
)
from airshed.llm.common import table


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.digest(table(spark, sf_dir, "pages"))


def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.digest(table(spark, sf_dir, "pages"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.digest(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.deduplicated(table(spark, sf_dir, "embeddings"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.sequences(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.joined(table(spark, sf_dir, "documents"))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.digest(table(spark, sf_dir, "documents"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.digest(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_html,
        op2_urls,
        op3_pii,
        op4_language,
        op5_decontamination,
        op6_embeddings,
        op7_packing,
        op8_quality,
        op9_secrets,
        op10_ngram_join,
        op11_manifest,
        op12_sharding,
        op13_prefix_trie,
    )
}

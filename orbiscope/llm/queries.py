"""The registered corpus queries, each over its whole table, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orbiscope.llm import decontaminate, html_text, jaccard_join, langid, licenses, packing, pii, token_counts, topk_search, toxicity
from orbiscope.llm.common import table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_query(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest_query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest_query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.digest_query(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_query(table(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_query(table(spark, sf_dir, "documents"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similarity_classes(table(spark, sf_dir, "documents"), k=3, percent=90)


def op9_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.search_query(table(spark, sf_dir, "embeddings"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest_query(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_decontaminate": op2_decontaminate,
    "op3_toxicity": op3_toxicity,
    "op4_language_id": op4_language_id,
    "op5_packing": op5_packing,
    "op6_license_scan": op6_license_scan,
    "op7_html_text": op7_html_text,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_topk_search": op9_topk_search,
    "op10_pii": op10_pii,
}

ORACLE_SQL: dict[str, str] = {
    "op2_decontaminate": decontaminate.ORACLE,
    "op8_jaccard_join": jaccard_join.ORACLE,
    "op9_topk_search": topk_search.ORACLE,
}

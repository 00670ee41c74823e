"""The registered queries of this subpackage: each applies one operator, with its production
parameters, to its whole table and derives the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import chat, decontaminate, language, ngram_join, quality, sentencepiece_codec, suffix_dedup, token_counts, url_rules, warc
from tidelog.llm.common import table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    document = url_rules.url_document(F.col("path"))
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), document=document)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_documents(table(spark, sf_dir, "documents"))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.digests(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_url_filters": op2_url_filters,
    "op3_decontamination": op3_decontamination,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_ngram_join": op5_ngram_join,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_token_counts": op7_token_counts,
    "op8_quality_rules": op8_quality_rules,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_warc": op10_warc,
}

OP10_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_page FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {warc.REVISIT_BYTES} AND page_id > first_page THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {warc.REVISIT_BYTES} AND page_id > first_page THEN first_page END AS refers_to
FROM f
"""

ORACLE_SQL: dict[str, str] = {
    "op2_url_filters": url_rules.JUDGE_SQL,
    "op3_decontamination": decontaminate.CONTAMINATION_SQL,
    "op4_suffix_dedup": suffix_dedup.DEDUP_SQL,
    "op5_ngram_join": ngram_join.JOIN_SQL,
    "op6_chat_formatting": chat.ROTATE_SQL,
    "op8_quality_rules": quality.JUDGE_SQL,
    "op10_warc": OP10_SQL,
}

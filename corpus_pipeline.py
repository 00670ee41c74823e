"""A corpus pipeline over ``documents``: each stage reads what its predecessor wrote.

1. language_id: texts without a language (``und``) or below MIN_SCORE go.
2. ngram_join: one document of each group of near duplicates (word shingles of NEAR_SIZE, NEAR_PERCENT) stays.
3. suffix_dedup: bytes of strings of 200 bytes that repeat anywhere are cut out of the texts.
4. decontamination: documents contaminated by the benchmark go.
5. sentencepiece: what is left is encoded and decoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import decontaminate, language, ngram_join, sentencepiece_codec, suffix_dedup
from tidelog.llm.common import discard, stash, table

MIN_SCORE = 0.4
#: The stage's own values; op5's contract binds its query only.
NEAR_SIZE, NEAR_PERCENT = 5, 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language is recognised. The model learns from the input itself."""
    spoken = language.with_language(docs.select(F.struct("*").alias("_row"), F.col("text").alias("_text")), language.train(docs), "_text")
    known = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= MIN_SCORE)
    return spoken.where(known).select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs, size=NEAR_SIZE, percent=NEAR_PERCENT)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut the texts; n_chars follows."""
    cut = suffix_dedup.cut_documents(docs)
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.digests(docs)


STAGES = [
    ("language_id", language_id),
    ("ngram_join", near_duplicates),
    ("suffix_dedup", repeated_strings),
    ("decontamination", benchmark_passages),
    ("sentencepiece", token_ids),
]

#: SQL cannot express the first stage's model nor the last one's encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What a stage wrote goes when the next one has written."""
    docs, used = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name)
        discard(*used)
        used = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)

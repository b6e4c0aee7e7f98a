"""The corpus pipeline: stages that each work on all documents their predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import decontaminate, language, mixing, pii, simhash
from ledgerloom.llm.common import fresh, row_key, stored, table

# Learned languages and bit distances have no counterpart in SQL; tests compare with brute force.
ORACLE_SQL = None

# A secret in production; fixed here so that reruns agree.
PII_KEY = "example key"


def _by_key(docs: DataFrame, rows: DataFrame, how: str) -> tuple[DataFrame, str]:
    """The documents whose row key is (semi join) or is not (anti join) among ``rows``, and the
    name of their key column."""
    name = fresh(docs, "row_key")
    keyed = docs.withColumn(name, row_key(F.col("doc_id"), F.col("text")))
    return keyed.join(rows.select(F.col("row_key").alias(name)), name, how), name


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in none of the languages go, which are those without letters; those in several stay."""
    return language.accepted(docs, language.learn(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near-duplicates stays.

    Of rows with the same id and text the one with the least other columns stays.
    """
    groups = simhash.near_duplicates(docs)
    kept, key = _by_key(docs, groups.where("is_first"), "left_semi")
    one = kept.groupBy(key).agg(F.min(F.struct(*docs.columns)).alias("one"))
    return one.select(*[F.col("one")[c].alias(c) for c in docs.columns])


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    kept, _ = _by_key(docs, found.where("contaminated"), "left_anti")
    return kept.select(*docs.columns)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by pseudonyms of the same length."""
    return pii.pseudonymise(docs, key=PII_KEY)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mix(docs)


STAGES = [
    ("language", identify_language),
    ("simhash", near_duplicates),
    ("decontaminate", decontaminated),
    ("pii", without_personal_data),
    ("mix", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

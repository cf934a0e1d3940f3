"""The corpus pipeline: language, exact copies, near copies, secrets, packing.

Every stage works on all rows the one before kept. Its rows are written and read again, so a lost
executor costs one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyground.llm import exact_dedup, language_id, ngram_join, packing, secret_scan
from skyground.llm.common import freed, staged, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter have no language and go."""
    return language_id.identify(docs).filter(F.col("lang_pred") != language_id.UNKNOWN).select(*docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text stays."""
    return exact_dedup.keep_first(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return ngram_join.keep_one(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; what looks like a live secret is masked, and its length follows."""
    masked = secret_scan.redact(docs.withColumn("_before", F.length("text")), by_docs=True)
    changed = F.length("text") != F.col("_before")
    return masked.withColumn(
        "n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    ).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("exact_dedup", exact_copies),
    ("ngram_join", near_copies),
    ("secret_scan", without_secrets),
    ("packing", packed),
]

# SQL cannot state the language and packing stages; tests hold the rows against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again as the next one's, and go after it."""
    docs, done = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        freed(*done)
        done = [docs]
    return docs

"""The corpus pipeline: documents through language, near-duplicate, repeat and packing stages.

Each stage gets what its predecessor kept, as written Parquet, and returns the columns of
``documents``; the last returns the pieces of packed sequences.

Texts that are null, empty or without a letter go in the first stage, as do texts of any length that are in none
of the languages the table teaches. Repeated rows are near duplicates: one stays. Null ids stay null, and documents
without id are told apart by their texts. Other columns are dropped. An empty table gives no pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rungwise.llm.common import bound_batches, bound_rows, read_table
from rungwise.llm.langid import keep_known
from rungwise.llm.packing import pack
from rungwise.llm.simhash import one_of_each_group
from rungwise.llm.suffix_dedup import without_repeats
from rungwise.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def columns_of(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The columns of ``documents``; a stage may be the session's first, so it bounds Arrow batches itself."""
    bound_rows(spark)
    bound_batches(spark)
    return docs.select(COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the table teaches; garbled texts and those without a letter are in none."""
    return keep_known(columns_of(spark, docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return one_of_each_group(columns_of(spark, docs))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the byte strings that also stand elsewhere; its text may become empty."""
    return without_repeats(columns_of(spark, docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences."""
    return pack(columns_of(spark, docs), public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", language), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
    ("packing", packing),
]
# Trained weights, fingerprints of shingles and tokenisers are not SQL: tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again."""
    docs, folder = read_table(spark, sf_dir, "documents"), scratch_path(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

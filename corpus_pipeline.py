"""From raw documents to packed sequences: the corpus operators in a row.

``STAGES`` lists the stages in order. Each is a function of ``(spark, docs, sf_dir)``
whose result is written as Parquet and read again as the next stage's ``docs``. All but
the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import mixing, packing, quality_rules, simhash, substrings
from tidemark.sources.scratch import pin

# Of the tokens that reach the mix. One epoch, so that a document comes once at most.
MIX_SHARE = 0.75
MIX_EPOCHS = 1


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or a certified cutoff go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.keep_good(docs, labels)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the least id."""
    return simhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that repeat an earlier document leave the texts; all documents stay."""
    return substrings.without_repeats(docs)


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents beyond their leaf's budget go."""
    return mixing.keep_mixed(docs, MIX_SHARE, MIX_EPOCHS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of power-of-two length, one row per sequence."""
    return packing.packed_digest(docs)


STAGES = [
    ("good_documents", good_documents),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("target_mix", target_mix),
    ("pack", pack),
]

# Fingerprints and token ids cannot be written in SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *before, (_, last) = STAGES
    for name, stage in before:
        docs = pin(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)

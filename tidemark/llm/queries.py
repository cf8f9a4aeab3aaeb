"""One registered query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    filter_audit,
    langid,
    licenses,
    lm_scores,
    mixing,
    packing,
    quality_rules,
    simhash,
    spelling,
    spotsigs,
    substrings,
    token_shards,
    warc,
)
from tidemark.llm.filter_audit_sql import AUDIT
from tidemark.llm.licenses_sql import LICENSES
from tidemark.llm.mixing_sql import MIX
from tidemark.llm.quality_sql import QUALITY
from tidemark.sources.scratch import new_folder

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.against_edits(_table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_all(_table(spark, sf_dir, "documents"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = mixing.mix(mixing.leaves_of(_table(spark, sf_dir, "documents")))
    epoch = F.col("epoch").cast("bigint").alias("epoch")
    taken = F.col("taken").alias("tokens")
    return chosen.select("doc_id", "domain", "lang", "source", taken, epoch)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_digest(_table(spark, sf_dir, "documents"))


def op7_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.write_shards(_table(spark, sf_dir, "documents"), new_folder(spark, "shards"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.repeats(_table(spark, sf_dir, "documents"))
    lengths = F.aggregate("repeats", F.lit(0).cast("bigint"), lambda n, s: n + s["length"])
    return found.select(
        "doc_id", "n_words", lengths.alias("n_removed"), F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op10_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    derived = warc.derive(warc.responses(_table(spark, sf_dir, "pages")))
    return derived.select(
        *[c for c in derived.columns if c != "block"],
        F.octet_length("block").cast("bigint").alias("content_length"),
        F.col("block").cast("string").alias("content"),
    )


def op11_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores.scores(_table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    fn.__name__: fn
    for fn in (
        op1_document_fingerprints,
        op2_license_scan,
        op3_simhash_near_dedup,
        op4_quality_rules,
        op5_mixing,
        op6_packing,
        op7_token_shards,
        op8_language_id,
        op9_substring_dedup,
        op10_warc_derivatives,
        op11_filter_interaction_audit,
        op12_lm_scores,
        op13_spelling_variants,
    )
}

# The others hash, tokenise, learn or parse in ways that SQL cannot express; tests hold
# them against brute force.
SQL: dict[str, str] = {
    "op2_license_scan": LICENSES,
    "op4_quality_rules": QUALITY,
    "op5_mixing": MIX,
    "op11_filter_interaction_audit": AUDIT,
}

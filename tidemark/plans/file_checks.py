"""Declared tests answered by the footers of Parquet files, without reading a row."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.quality import freshness, not_null
from tidemark.sources.footers import column_footer, file_footers, listed_files

_EPOCH = "1970-01-01 00:00:00"


def table_footers(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Footers of all Parquet files of a table's folder, for the given columns."""
    return file_footers(listed_files(spark, path, "*.parquet"), columns)


def _files(spark: SparkSession, path: str, footers: DataFrame) -> DataFrame | None:
    """The rows of the files of ``footers``; None without any."""
    paths = [r.path for r in footers.select("path").collect()]
    return spark.read.option("basePath", path).parquet(*paths) if paths else None


def file_not_null(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """:func:`quality.not_null` of a table from its footers' NULL counts.

    A column that a file does not have counts as NULL in all of its rows. Files whose footers
    do not count NULLs are read, and no others.
    """
    footers = table_footers(spark, path, columns)
    known, silent = F.lit(True), {}
    for c in columns:
        found = column_footer(c)
        silent[c] = F.when(found.isNull(), F.col("n_rows")).otherwise(found["nulls"])
        known = known & silent[c].isNotNull()
    sums = footers.where(known).agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(c) for c, n in silent.items()))
    pairs = ", ".join(f"'not_null: {c}', `{c}`" for c in columns)
    rows = sums.selectExpr(f"stack({len(columns)}, {pairs}) AS (check, failing_rows)")
    rest = _files(spark, path, footers.where(~known))
    if rest is not None:
        rows = rows.unionByName(not_null(rest, columns).select("check", "failing_rows"))
    total = rows.groupBy("check").agg(F.sum("failing_rows").alias("failing_rows"))
    return total.select("check", (F.col("failing_rows") == 0).alias("passed"), "failing_rows")


def file_freshness(
    spark: SparkSession, path: str, as_of: datetime, ts: str = "event_timestamp", **hours: int
) -> DataFrame:
    """:func:`quality.freshness` of a table from its footers' newest timestamps.

    Files whose footers do not say, such as those with 96-bit timestamps, are read.
    """
    footers = table_footers(spark, path, [ts])
    found = column_footer(ts)
    empty = (F.col("n_rows") == 0) | found.isNull() | F.coalesce(found["nulls"] == F.col("n_rows"), F.lit(False))
    said = empty | found["newest_micros"].isNotNull()
    epoch = F.lit(_EPOCH).cast("timestamp_ntz")
    newest = F.timestamp_add("MICROSECOND", found["newest_micros"], epoch)
    rows = footers.where(said).select(newest.alias(ts))
    rest = _files(spark, path, footers.where(~said))
    if rest is not None:
        rows = rows.unionByName(rest.select(F.col(ts).cast("timestamp_ntz").alias(ts)))
    return freshness(rows, as_of, ts, **hours)

"""Equi-joins of a large fact side whose keys may be very uneven."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 0.001  # a key with more rows than this share gets split
TRACKED = 8192  # counters per frequent-items sketch; its error is far below HOT_SHARE
LANES = 64  # tasks that merge sketches
WORTH_SPLITTING = 10_000  # rows
MOST_PIECES = 4096
NULL_PIECES = 1024  # rows without a key match nothing, so spreading them is free


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> dict:
    """Keys that hold more than about ``share`` of the rows, and into how many pieces to split each.

    There are at most ``1 / share`` of them, with pieces, a power of two, of about
    ``share`` of the rows each.

    Every task keeps a frequent-items sketch, ``LANES`` tasks merge them, and the
    driver adds up the few top keys of each. The answer steers how rows are spread,
    never which rows are kept, and is fixed here so that both sides of a join agree
    on it. One scan of the key column; pass the answer on to every join of the same rows.
    """
    most = int(1 / share)
    lanes = (
        df.where(F.col(key).isNotNull())
        .groupBy(F.pmod(F.spark_partition_id(), F.lit(LANES)).alias("lane"))
        .agg(
            F.expr(f"approx_top_k(`{key}`, {most}, {TRACKED})").alias("top"),
            F.count("*").alias("n"),
        )
        .collect()
    )
    counts: Counter = Counter()
    for lane in lanes:
        for item in lane.top:
            counts[item["item"]] += item["count"]
    # A key is only worth splitting when its share of the rows fills several tasks.
    floor = max(share * sum(lane.n for lane in lanes), WORTH_SPLITTING)
    return {
        item: min(2 ** ceil(log2(n / floor) + 1), MOST_PIECES)
        for item, n in counts.most_common(most)
        if n > floor
    }


def _pieces(key: Column, hot: dict) -> Column:
    """How many pieces the rows of a key are split into; 1 for most keys."""
    by_count: dict[int, list] = {}
    for item, pieces in hot.items():
        by_count.setdefault(pieces, []).append(item)
    chosen = F.lit(1)
    for pieces, items in by_count.items():
        chosen = F.when(key.isin(items), F.lit(pieces)).otherwise(chosen)
    return chosen


def skewed_join(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    also: Column | None = None,
    how: str = "inner",
    spread_by: Sequence[str] = (),
    hot: dict | None = None,
) -> DataFrame:
    """Join ``facts`` to the few rows per key of ``dim`` without overloading a task.

    Rows of a hot or NULL key are spread over pieces by a hash of ``spread_by``;
    the dimension rows of hot keys are repeated once per piece. All other keys
    keep a single piece, so the usual join strategies apply. ``also`` is a further
    condition between columns of the two sides; they may share no column name but
    the key. A ``right`` join keeps every key of ``dim``, once per piece where it
    is hot: aggregate it with min or max only.
    """
    if how not in ("inner", "left", "right"):
        raise ValueError(f"unsupported join type {how!r}")
    if hot is None:
        hot = hot_keys(facts, key)
    left, right = facts, dim.withColumnRenamed(key, "__key")
    cond = F.col(key) == F.col("__key")
    if hot or how == "left":
        pieces = F.when(F.col(key).isNull(), F.lit(NULL_PIECES)).otherwise(_pieces(F.col(key), hot))
        piece = F.pmod(F.xxhash64(*(spread_by or facts.columns)), pieces).cast("int")
        left = facts.withColumn("__piece", piece)
        last = _pieces(F.col("__key"), hot) - F.lit(1)
        right = right.withColumn("__dim_piece", F.explode(F.sequence(F.lit(0), last)))
        cond = cond & (F.col("__piece") == F.col("__dim_piece"))
    if also is not None:
        cond = cond & also
    joined = left.join(right, cond, how)
    if how == "right":
        joined = joined.withColumn(key, F.col("__key"))
    return joined.drop("__key", "__piece", "__dim_piece")

"""Dense numbering and ranks over a whole table, without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.sources.scratch import pin

# monotonically_increasing_id keeps the task number above this bit.
_TASK_BITS = 33


def _sorted_with_offsets(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Rows in total order with ``__rank`` (1..n) and ``__total`` (n).

    The rows are range-partitioned and sorted by Spark, written out once so that
    their split is fixed, and then shifted by the row count of earlier pieces.
    ``order`` must be unique per row; equal leading values may then span tasks.
    """
    numbered = df.orderBy(*order).withColumn("__id", F.monotonically_increasing_id())
    fixed = pin(numbered, "ranked")
    piece = F.shiftrightunsigned("__id", _TASK_BITS)
    within = F.col("__id").bitwiseAND(F.lit((1 << _TASK_BITS) - 1))
    # One row per sort task, so the window and the broadcast stay small.
    sizes = fixed.groupBy(piece.alias("__task")).agg(F.count("*").alias("__n"))
    before = W.orderBy("__task").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        "__task",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
        F.sum("__n")
        .over(W.orderBy("__task").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
        .alias("__total"),
    )
    return (
        fixed.withColumn("__task", piece)
        .join(F.broadcast(offsets), "__task")
        .withColumn("__rank", F.col("__before") + within + F.lit(1))
        .drop("__id", "__task", "__before")
    )


def dense_keys(
    df: DataFrame,
    order: Sequence[Column | str],
    name: str,
    start: int = 0,
    row_id: str | None = None,
) -> DataFrame:
    """Add ``name``, numbering all rows ``start + 1 .. start + n`` in the given order.

    With ``row_id``, a column unique per row, only it and the columns of ``order`` are
    sorted and written; the numbers join back to wide rows by it.
    """
    if row_id is not None:
        names = list(dict.fromkeys([row_id, *order]))
        numbered = dense_keys(df.select(*names), order, name, start).select(row_id, name)
        return df.join(numbered, row_id).select(*df.columns, name)
    ranked = _sorted_with_offsets(df, order)
    return ranked.withColumn(name, F.col("__rank") + F.lit(start)).select(*df.columns, name)


# Hex digits of the id's MD5 that choose a lane: 16 ** 3 lanes per day. It bounds the tasks
# that can number one day's rows, and all stored keys depend on it: never change it.
_LANE_DIGITS = 3
LANES = 16**_LANE_DIGITS


def lane_keys(df: DataFrame, within: str, row_id: str, order: Sequence[str], name: str) -> DataFrame:
    """Add ``name``, unique among the rows of each ``within`` value and the same on every rerun.

    Rows are dealt to lanes by a hash of their unique id and numbered per lane;
    lane ``l`` gives out ``l + 1, l + 1 + LANES, …``. Lanes are even whatever the
    data, so one shuffle is enough and no order over the whole table is needed.
    """
    digest = F.md5(F.col(row_id).cast("string"))
    lane = F.conv(F.substring(digest, 1, _LANE_DIGITS), 16, 10).cast("bigint")
    in_lane = W.partitionBy(within, "__lane").orderBy(*order)
    number = (F.row_number().over(in_lane) - F.lit(1)) * F.lit(LANES).cast("bigint")
    return (
        df.withColumn("__lane", lane)
        .withColumn(name, number + F.col("__lane") + F.lit(1))
        .select(*df.columns, name)
    )


def ntile_of(rank: Column, total: Column, buckets: int) -> Column:
    """Bucket of the 1-based ``rank`` among ``total`` rows; the first ones take the remainder."""
    size = F.floor(total / F.lit(buckets))
    extra = total - size * F.lit(buckets)
    wide = extra * (size + F.lit(1))
    in_wide = F.floor((rank - F.lit(1)) / (size + F.lit(1))) + F.lit(1)
    in_rest = extra + F.floor((rank - F.lit(1) - wide) / F.nullif(size, F.lit(0))) + F.lit(1)
    return F.when(rank <= wide, in_wide).otherwise(in_rest).cast("bigint")


def percent_rank_of(ahead: Column, total: Column) -> Column:
    """Share of the other rows that come strictly ahead; 0 for a single row."""
    others = total - F.lit(1)
    return F.coalesce(ahead.cast("double") / F.nullif(others, F.lit(0)), F.lit(0.0))


def rank_descending(
    df: DataFrame, value: str, tiebreak: str, buckets: int, pr_name: str, tile_name: str
) -> DataFrame:
    """Percent rank by descending ``value`` and ntile with ``tiebreak`` for equal values."""
    ranked = _sorted_with_offsets(df, [F.col(value).desc(), F.col(tiebreak).asc()])
    # One row per distinct value, written out so that Spark knows its size when it
    # picks the join: a broadcast while small, else a sort-merge that splits skew.
    first = pin(ranked.groupBy(value).agg(F.min("__rank").alias("__first")), "ties")
    return (
        ranked.join(first, value)
        .withColumn(pr_name, percent_rank_of(F.col("__first") - F.lit(1), F.col("__total")))
        .withColumn(tile_name, ntile_of(F.col("__rank"), F.col("__total"), buckets))
        .select(*df.columns, pr_name, tile_name)
    )

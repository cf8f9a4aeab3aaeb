"""Type-2 user history: closed form, daily merge, point-in-time join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.asof import asof_join
from tidemark.operators.keys import dense_keys
from tidemark.operators.latest import latest_per_key
from tidemark.schemas import DEFAULT_TIER, open_end
from tidemark.sources.scratch import pin

KEY = "user_id"
TS = "event_timestamp"
# Dimension column -> batch column whose value it tracks.
TRACKED: Mapping[str, str] = {"country": "country", "preferred_platform": "platform"}


def _latest_attributes(
    events: DataFrame, keys: Sequence[str], tracked: Mapping[str, str], ts: str, tiebreak: str
) -> DataFrame:
    """Newest attributes per key. A snapshot with an unknown attribute is no change, so it goes."""
    narrow = events.select(*keys, ts, tiebreak, *dict.fromkeys(tracked.values()))
    latest = latest_per_key(narrow.where(F.col(keys[0]).isNotNull()), keys, ts, tiebreak)
    return latest.select(
        *keys, F.col(ts).alias("seen_at"), *(F.col(b).alias(d) for d, b in tracked.items())
    ).dropna(subset=list(tracked))


def scd2_history(
    events: DataFrame,
    key: str = KEY,
    tracked: Mapping[str, str] = TRACKED,
    ts: str = TS,
    batch: str = "event_date",
    tiebreak: str = "event_id",
    new_key_start: str = "latest",
    surrogate: str | None = "user_sk",
    batch_as: str | None = None,
) -> DataFrame:
    """Every version of every key, as if each ``batch`` value had been merged in order.

    A key's first version starts at its newest event of the first batch, or with
    ``new_key_start="first"`` at its very first event. Windows here see one row
    per key and batch, whatever the number of events. ``batch_as`` names a column for
    the batch that opened the version.
    """
    if new_key_start not in ("latest", "first"):
        raise ValueError(f"unknown new_key_start {new_key_start!r}")
    snapshots = _latest_attributes(events, [key, batch], tracked, ts, tiebreak)
    by_batch = W.partitionBy(key).orderBy(batch)
    differs = F.lag("seen_at").over(by_batch).isNull()
    for name in tracked:
        differs = differs | (F.col(name) != F.lag(name).over(by_batch))
    starts = snapshots.withColumn("__starts", differs).where(F.col("__starts"))
    if new_key_start == "first":
        known = events.where(F.col(key).isNotNull())
        first_seen = known.groupBy(key).agg(F.min(ts).alias("__first"))
        is_first = F.lag("seen_at").over(by_batch).isNull()
        starts = (
            starts.withColumn("__is_first", is_first)
            .join(first_seen, key)
            .withColumn("seen_at", F.when(F.col("__is_first"), F.col("__first")).otherwise(F.col("seen_at")))
        )
    following = F.lead("seen_at").over(by_batch)
    versions = starts.select(
        key,
        *tracked,
        F.lit(DEFAULT_TIER).alias("user_tier"),
        F.col("seen_at").alias("valid_from"),
        F.coalesce(following, open_end()).alias("valid_to"),
        following.isNull().alias("is_current"),
        *([F.col(batch).alias(batch_as)] if batch_as else []),
    )
    if surrogate is None:
        return versions
    return dense_keys(versions, ["valid_from", key], surrogate).select(
        surrogate, *versions.columns
    )


def new_keys(
    current: DataFrame,
    batch: DataFrame,
    key: str = KEY,
    tracked: Mapping[str, str] = TRACKED,
    ts: str = TS,
    tiebreak: str = "event_id",
) -> DataFrame:
    """Newest batch attributes of keys that have no open version."""
    latest = _latest_attributes(batch, [key], tracked, ts, tiebreak)
    return latest.join(current.select(key), key, "left_anti")


def _changed(tracked: Mapping[str, str]) -> Column:
    """Whether the newest attributes ``__…`` differ from those held."""
    changed: Column = F.lit(False)
    for name in tracked:
        changed = changed | (F.col(name) != F.col(f"__{name}"))
    return F.coalesce(changed, F.lit(False))


def _refuse_late(joined: DataFrame, tracked: Mapping[str, str]) -> None:
    """A version must start after the one that it ends."""
    late = joined.where(_changed(tracked) & (F.col("__at") <= F.col("valid_from")))
    if row := late.select("__at", "valid_from").head():
        raise ValueError(f"a batch row of {row[0]} is older than the version of {row[1]}")


def opened_versions(
    current: DataFrame,
    batch: DataFrame,
    next_key: int,
    key: str = KEY,
    tracked: Mapping[str, str] = TRACKED,
    ts: str = TS,
    tiebreak: str = "event_id",
    surrogate: str = "user_sk",
) -> DataFrame:
    """The versions that ``batch`` opens, given the one open version per key in ``current``.

    Only new and changed keys give a row. Both sides hold one row per key, so the join
    is even.
    """
    latest = _latest_attributes(batch, [key], tracked, ts, tiebreak).select(
        key, F.col("seen_at").alias("__at"), *(F.col(d).alias(f"__{d}") for d in tracked)
    )
    joined = latest.join(current.select(key, *tracked, "valid_from"), key, "left")
    starts = pin(joined.where(F.col("valid_from").isNull() | _changed(tracked)), "opened")
    _refuse_late(starts, tracked)
    rows = starts.select(
        key,
        *(F.col(f"__{d}").alias(d) for d in tracked),
        F.lit(DEFAULT_TIER).alias("user_tier"),
        F.col("__at").alias("valid_from"),
    )
    numbered = dense_keys(rows, ["valid_from", key], surrogate, start=next_key - 1)
    return numbered.select(surrogate, *rows.columns)


def merge_open(
    current: DataFrame,
    batch: DataFrame,
    next_key: int,
    key: str = KEY,
    tracked: Mapping[str, str] = TRACKED,
    ts: str = TS,
    tiebreak: str = "event_id",
    surrogate: str = "user_sk",
) -> tuple[DataFrame, DataFrame]:
    """Merge one batch into the open versions; returns ``(closed, current)``.

    ``closed`` are the versions this batch ended and ``current`` all open ones
    after it. Earlier history is neither read nor rewritten. Both sides hold one
    row per key, so the full join is even.
    """
    out_cols = [surrogate, key, *tracked, "user_tier", "valid_from", "valid_to", "is_current"]
    latest = _latest_attributes(batch, [key], tracked, ts, tiebreak).select(
        key, F.col("seen_at").alias("__at"), *(F.col(d).alias(f"__{d}") for d in tracked)
    )
    held = F.col(surrogate).isNotNull()
    changed = held & F.col("__at").isNotNull() & _changed(tracked)
    _refuse_late(current.join(latest, key), tracked)

    def row(*values: Column) -> Column:
        return F.struct(*(v.alias(c) for v, c in zip(values, out_cols, strict=True)))

    kept = row(*(F.col(c) for c in out_cols))
    ended = row(
        *(F.col(c) for c in out_cols[:-2]),
        F.col("__at"),
        F.lit(False),
    )
    opened = row(
        F.lit(None).cast("bigint"),
        F.col(key),
        *(F.col(f"__{d}") for d in tracked),
        F.lit(DEFAULT_TIER),
        F.col("__at"),
        open_end(),
        F.lit(True),
    )
    rows = (
        F.when(changed, F.array(ended, opened)).when(held, F.array(kept)).otherwise(F.array(opened))
    )
    merged = pin(
        current.select(*out_cols)
        .join(latest, key, "full_outer")
        .select(F.explode(rows).alias("r"))
        .select("r.*"),
        "scd2",
    )
    opened_rows = merged.where(F.col(surrogate).isNull()).drop(surrogate)
    numbered = dense_keys(opened_rows, ["valid_from", key], surrogate, start=next_key - 1)
    unchanged = merged.where(F.col("is_current") & F.col(surrogate).isNotNull())
    return merged.where(~F.col("is_current")), unchanged.unionByName(numbered)


def scd2_merge(
    dim: DataFrame,
    batch: DataFrame,
    key: str = KEY,
    tracked: Mapping[str, str] = TRACKED,
    ts: str = TS,
    tiebreak: str = "event_id",
    surrogate: str = "user_sk",
    batch_day: str = "event_date",
    rebuild: DataFrame | None = None,
) -> DataFrame:
    """The whole dimension after one daily batch.

    A batch older than the newest version would leave overlapping intervals, so
    it is refused. Pass the full staged events as ``rebuild`` to derive the
    history anew instead.
    """
    newest = dim.agg(F.max("valid_from").alias("at"), F.max(surrogate).alias("sk")).first()
    oldest = batch.agg(F.min(batch_day).alias("day")).first().day
    if newest.at is not None and oldest is not None and oldest < newest.at.date():
        if rebuild is None:
            raise ValueError(f"batch of {oldest} is older than the version of {newest.at}")
        return scd2_history(rebuild, key, tracked, ts, batch_day, tiebreak, surrogate=surrogate)
    out_cols = [surrogate, key, *tracked, "user_tier", "valid_from", "valid_to", "is_current"]
    closed, current = merge_open(
        dim.where("is_current"), batch, (newest.sk or 0) + 1, key, tracked, ts, tiebreak, surrogate
    )
    history = dim.where(~F.col("is_current")).select(*out_cols)
    return history.unionByName(closed).unionByName(current)


def pit_join(
    facts: DataFrame,
    dim: DataFrame,
    key: str = KEY,
    ts: str = TS,
    how: str = "inner",
    take: Sequence[str] = ("user_sk",),
    spread_by: Sequence[str] = ("event_id",),
    hot: dict | None = None,
) -> DataFrame:
    """Attach the version valid at each fact's time: ``valid_from <= ts < valid_to``.

    Versions of a key do not overlap, so a fact matches at most one. Facts before
    the first version are dropped, or kept without it when ``how="left"``. A key costs its
    facts plus its versions, see :mod:`tidemark.operators.asof`.
    """
    return asof_join(facts, dim, key, ts, "valid_from", "valid_to", take, how, spread_by, hot)


def interval_problems(
    dim: DataFrame, key: str = KEY, start: str = "valid_from", stop: str = "valid_to"
) -> DataFrame:
    """Failing rows per invariant: positive length, no overlap, one open version per key."""
    by_start = W.partitionBy(key).orderBy(start, stop)
    per_row = dim.select(
        key,
        "is_current",
        (F.col(stop) <= F.col(start)).alias("empty"),
        F.coalesce(F.lead(start).over(by_start) < F.col(stop), F.lit(False)).alias("overlap"),
    )
    per_key = per_row.groupBy(key).agg(
        F.count_if("empty").alias("empty"),
        F.count_if("overlap").alias("overlap"),
        F.count_if("is_current").alias("open"),
    )
    totals = per_key.agg(
        F.coalesce(F.sum("empty"), F.lit(0)).alias("empty"),
        F.coalesce(F.sum("overlap"), F.lit(0)).alias("overlap"),
        F.count_if(F.col("open") != 1).alias("open"),
    )
    return totals.selectExpr(
        "stack(3, 'empty_interval', empty, 'overlap', overlap, 'not_one_current', open) "
        "AS (check, failing_rows)"
    ).select("check", (F.col("failing_rows") == 0).alias("passed"), "failing_rows")

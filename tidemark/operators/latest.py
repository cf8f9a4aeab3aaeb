"""One row per key by an ordering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], latest: bool) -> DataFrame:
    # An aggregate keeps one row per key inside each input task, before the
    # shuffle, so a key with very many rows stays cheap.
    rest = [c for c in df.columns if c not in keys]
    choose = F.max_by if latest else F.min_by
    row = choose(F.struct(*rest), F.struct(*order)).alias("__row")
    return df.groupBy(*keys).agg(row).select(*keys, "__row.*").select(*df.columns)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    ts: str = "event_timestamp",
    tiebreak: str = "event_id",
) -> DataFrame:
    """Keep the newest row of every key; ``tiebreak`` decides equal timestamps."""
    return _pick(df, keys, [ts, tiebreak], latest=True)


def earliest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    ts: str = "event_timestamp",
    tiebreak: str = "event_id",
) -> DataFrame:
    """Keep the oldest row of every key; ``tiebreak`` decides equal timestamps."""
    return _pick(df, keys, [ts, tiebreak], latest=False)

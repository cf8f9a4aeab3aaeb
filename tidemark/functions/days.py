"""Predicates over day columns."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: date | str) -> date:
    if isinstance(value, datetime):
        return value.date()
    return value if isinstance(value, date) else date.fromisoformat(value)


def between_days(day: Column | str, first: date | None = None, last: date | None = None) -> Column:
    """Inclusive range over a DATE column, as literals so that partitions prune."""
    col = F.col(day) if isinstance(day, str) else day
    keep = F.lit(True)
    if first is not None:
        keep = keep & (col >= F.lit(first))
    if last is not None:
        keep = keep & (col <= F.lit(last))
    return keep


def within_day(ts: Column | str, day: date | str) -> Column:
    """Timestamp range of one day; reaches the file statistics, unlike a cast to DATE."""
    col = F.col(ts) if isinstance(ts, str) else ts
    start = as_date(day)
    stop = start + timedelta(days=1)
    low = F.lit(f"{start} 00:00:00").cast("timestamp_ntz")
    high = F.lit(f"{stop} 00:00:00").cast("timestamp_ntz")
    return (col >= low) & (col < high)

"""Literal lookups in the fact tables, through partitions, row-group filters and sort order.

Each returns plain predicates over literals, so that Spark prunes days by their folders and
skips row groups by what the sink has written for :data:`EVENT_LOOKUPS` and
:data:`ORDER_LOOKUPS`: the rows of a key lie in one file of a day, and the other files' bloom
filters rule it out. Lookups over no given days open the footers of all days, no more.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.days import as_date, between_days

# How the sinks lay out the facts: rows of one of these together, filters for all of those.
EVENT_CLUSTER = ("user_id",)
EVENT_LOOKUPS = ("user_id", "session_id", "event_id")
ORDER_CLUSTER = ("user_sk",)
ORDER_LOOKUPS = ("user_sk", "order_id")


def _on(days: Iterable[date | str] | None, part: str) -> Column:
    if days is None:
        return F.lit(True)
    return F.col(part).isin([as_date(d) for d in days])


def session_events(
    events: DataFrame, session_id: str, days: Iterable[date | str] | None = None
) -> DataFrame:
    """The events of a session."""
    return events.where(_on(days, "event_date") & (F.col("session_id") == F.lit(session_id)))


def user_events(
    events: DataFrame,
    user_id: str,
    event_type: str | None = None,
    days: Iterable[date | str] | None = None,
) -> DataFrame:
    """The events of a user, of one type if given."""
    found = events.where(_on(days, "event_date") & (F.col("user_id") == F.lit(user_id)))
    return found if event_type is None else found.where(F.col("event_type") == F.lit(event_type))


def user_orders(
    orders: DataFrame,
    user_sk: int,
    since: date | str | None = None,
    until: date | str | None = None,
) -> DataFrame:
    """The orders of a user version, on days from ``since`` to ``until`` where given."""
    days = between_days(
        "order_date",
        None if since is None else as_date(since),
        None if until is None else as_date(until),
    )
    return orders.where(days & (F.col("user_sk") == F.lit(user_sk).cast("bigint")))

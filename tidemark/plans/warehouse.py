"""Warehouse tables as named views, from daily loads or straight from the lake."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.skew import hot_keys
from tidemark.plans import daily
from tidemark.plans.dims import dim_date_of, dim_product, dim_user_snapshot
from tidemark.plans.facts import snapshot_fact_events, snapshot_fact_orders
from tidemark.sources.events import read_events
from tidemark.sources.published import read_state


def loaded_tables(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    """The tables the daily loads have built, plus calendar and catalogue."""
    # One state for all, so that a load in between does not show in some of them only.
    state = read_state(spark, warehouse)
    events = daily.read_fact_events(spark, warehouse, state)
    return {
        "dim_user": daily.read_dim_user(spark, warehouse, state=state),
        "dim_date": dim_date_of(events),
        "dim_product": dim_product(spark),
        "fact_events": events,
        "fact_orders": daily.read_fact_orders(spark, warehouse, state),
    }


def snapshot_tables(
    spark: SparkSession, lake: str, fmt: str = "parquet", typed: bool = False
) -> dict[str, DataFrame]:
    """A warehouse derived from the lake at once, with one open version per user."""
    raw = read_events(spark, lake, fmt, typed=typed)
    users = dim_user_snapshot(raw)
    hot = hot_keys(raw, "user_id")
    return {
        "v_raw_events": raw,
        "dim_user": users,
        "dim_date": dim_date_of(raw),
        "dim_product": dim_product(spark),
        "fact_events": snapshot_fact_events(raw, users, hot),
        "fact_orders": snapshot_fact_orders(raw, users, hot),
    }


def register_views(tables: dict[str, DataFrame], prefix: str = "") -> None:
    """Make the tables available to SQL under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")

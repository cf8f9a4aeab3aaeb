"""Staging and the event and order facts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import json_text, product_number
from tidemark.functions.days import as_date
from tidemark.operators.keys import dense_keys, lane_keys
from tidemark.operators.scd2 import pit_join
from tidemark.operators.skew import skewed_join
from tidemark.schemas import (
    DEFAULT_CURRENCY,
    DEFAULT_GATEWAY,
    DEFAULT_ORDER_STATUS,
    DEFAULT_PRODUCT_SK,
)
from tidemark.sources.events import typed_columns

_EVENT_COLUMNS = (
    "event_id",
    "event_timestamp",
    "event_date",
    "user_sk",
    "user_id",
    "platform",
    "country",
    "event_type",
    "session_id",
    "metadata",
)
_ORDER_COLUMNS = (
    "order_id",
    "event_id",
    "order_timestamp",
    "order_date",
    "user_sk",
    "user_id",
    "product_sk",
    "order_amount",
    "currency",
    "payment_gateway",
    "order_status",
)


def stage_events(raw: DataFrame, day: date | str | None = None) -> DataFrame:
    """Raw lake rows cast to the staged types; only those of ``day`` when given."""
    rows = raw if day is None else raw.where(F.col("date") == F.lit(as_date(day)))
    return rows.select(*typed_columns())


def _on_day(staged: DataFrame, day: date | str | None) -> DataFrame:
    return staged if day is None else staged.where(F.col("event_date") == F.lit(as_date(day)))


def purchases(events: DataFrame) -> DataFrame:
    """Purchase events with a positive amount."""
    return events.where((F.col("event_type") == "purchase") & (F.col("amount") > 0))


def product_lookup(
    events: DataFrame, products: DataFrame, hot: dict | None = None
) -> DataFrame:
    """Add ``product_sk``; unknown and missing products get the default member.

    A catalogue within Spark's broadcast size is broadcast; past that, popular
    products and rows without one are spread over many tasks.
    """
    items = products.select("product_id", F.col("product_sk").alias("__sk"))
    joined = skewed_join(events, items, "product_id", how="left", spread_by=["event_id"], hot=hot)
    default = F.lit(DEFAULT_PRODUCT_SK)
    return joined.withColumn("product_sk", F.coalesce("__sk", default)).drop("__sk")


def load_fact_events(
    staged: DataFrame,
    dim_user: DataFrame,
    day: date | str | None = None,
    keyed: bool = True,
    hot: dict | None = None,
) -> DataFrame:
    """Events with the user version valid at their time.

    ``event_sk`` is unique per day, and reloading a day gives the same keys.
    ``keyed=False`` leaves it out. ``hot`` is what ``hot_keys`` found for the users.
    """
    joined = pit_join(_on_day(staged, day), dim_user, hot=hot).select(*_EVENT_COLUMNS)
    if not keyed:
        return joined
    order = ["event_timestamp", "event_id"]
    return lane_keys(joined, "event_date", "event_id", order, "event_sk")


def load_fact_orders(
    staged: DataFrame,
    dim_user: DataFrame,
    dim_product: DataFrame,
    day: date | str | None = None,
    keyed: bool = True,
    hot: dict | None = None,
    hot_products: dict | None = None,
) -> DataFrame:
    """Positive purchases with user version, product, gateway and order constants."""
    bought = product_lookup(purchases(_on_day(staged, day)), dim_product, hot_products)
    gateway = json_text(F.col("metadata"), "payment_gateway")
    orders = (
        pit_join(bought, dim_user, hot=hot)
        .withColumns(
            {
                "order_id": F.concat(F.lit("ORD_"), F.col("event_id").cast("string")),
                "payment_gateway": F.coalesce(gateway, F.lit(DEFAULT_GATEWAY)),
                "currency": F.lit(DEFAULT_CURRENCY),
                "order_status": F.lit(DEFAULT_ORDER_STATUS),
            }
        )
        .withColumnsRenamed(
            {
                "event_timestamp": "order_timestamp",
                "event_date": "order_date",
                "amount": "order_amount",
            }
        )
        .select(*_ORDER_COLUMNS)
    )
    if not keyed:
        return orders
    order = ["order_timestamp", "event_id"]
    return lane_keys(orders, "order_date", "event_id", order, "order_sk")


def snapshot_fact_events(
    events: DataFrame, dim_user: DataFrame, hot: dict | None = None
) -> DataFrame:
    """All events joined to the one version per user, numbered by time."""
    users = dim_user.select("user_sk", "user_id")
    joined = skewed_join(events, users, "user_id", spread_by=["event_id"], hot=hot)
    order = ["event_timestamp", "event_id"]
    return dense_keys(joined.select(*_EVENT_COLUMNS), order, "event_sk", row_id="event_id")


def snapshot_fact_orders(
    events: DataFrame, dim_user: DataFrame, hot: dict | None = None
) -> DataFrame:
    """All positive purchases; product from its number, gateway left NULL when absent."""
    users = dim_user.select("user_sk", "user_id")
    joined = skewed_join(purchases(events), users, "user_id", spread_by=["event_id"], hot=hot)
    orders = joined.select(
        F.concat(F.lit("ORD_"), F.col("event_id").cast("string")).alias("order_id"),
        "event_id",
        F.col("event_timestamp").alias("order_timestamp"),
        F.col("event_date").alias("order_date"),
        "user_sk",
        "user_id",
        product_number(F.col("product_id")).alias("product_sk"),
        F.col("amount").alias("order_amount"),
        F.lit(DEFAULT_CURRENCY).alias("currency"),
        json_text(F.col("metadata"), "payment_gateway").alias("payment_gateway"),
        F.lit(DEFAULT_ORDER_STATUS).alias("order_status"),
    )
    return dense_keys(orders, ["order_timestamp", "event_id"], "order_sk", row_id="event_id")

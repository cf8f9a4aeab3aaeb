"""Calendar, product and first-seen user dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.keys import dense_keys
from tidemark.operators.latest import earliest_per_key
from tidemark.schemas import (
    DEFAULT_TIER,
    DEFAULTS,
    DIM_DATE,
    DIM_PRODUCT,
    PRODUCT_CATALOG,
    conform,
    open_end,
)


def calendar_columns(day: Column) -> list[Column]:
    """The calendar attributes of a day; weeks and weekdays follow ISO, Monday is 1."""
    weekday = F.weekday(day) + 1
    return [
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_id"),
        day.alias("calendar_date"),
        F.year(day).cast("smallint").alias("year"),
        F.quarter(day).cast("smallint").alias("quarter"),
        F.month(day).cast("smallint").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).cast("smallint").alias("day_of_month"),
        weekday.cast("smallint").alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.weekofyear(day).cast("smallint").alias("week_of_year"),
        (weekday >= 6).alias("is_weekend"),
    ]


def partition_label(day: Column) -> Column:
    """Name suffix of a daily partition, such as ``2024_01_30``."""
    return F.date_format(day, "yyyy_MM_dd")


def _with_calendar(days: DataFrame, holidays: DataFrame | None) -> DataFrame:
    out = days.select(*calendar_columns(F.col("calendar_date")))
    if holidays is not None:
        marked = holidays.select("calendar_date").distinct().withColumn("is_holiday", F.lit(True))
        out = out.join(marked, "calendar_date", "left")
    return conform(out, DIM_DATE, DEFAULTS["dim_date"])


def dim_date(
    spark: SparkSession, first: date, last: date, holidays: DataFrame | None = None
) -> DataFrame:
    """One row per day in ``first..last``. ``holidays`` has a ``calendar_date`` column."""
    start = F.unix_date(F.lit(first))
    days = spark.range((last - first).days + 1).select(
        F.date_from_unix_date((start + F.col("id")).cast("int")).alias("calendar_date")
    )
    return _with_calendar(days, holidays)


def dim_date_of(
    events: DataFrame, day: str = "event_date", holidays: DataFrame | None = None
) -> DataFrame:
    """The calendar that covers every day of ``events`` without gaps."""
    span = events.agg(F.min(day).alias("a"), F.max(day).alias("b")).where("a IS NOT NULL")
    days = span.select(F.explode(F.sequence("a", "b")).alias("calendar_date"))
    return _with_calendar(days, holidays)


def dim_product(spark: SparkSession) -> DataFrame:
    """The product catalogue."""
    # As VALUES, the planner knows how small the table is and broadcasts it.
    rows = ", ".join(
        f"({sk}, 'PRD_{sk:04d}', '{category} {sk}', '{category}', {price})"
        for sk, category, price in PRODUCT_CATALOG
    )
    values = spark.sql(
        f"SELECT * FROM VALUES {rows} AS (product_sk, product_id, product_name, category, base_price)"
    )
    return conform(values, DIM_PRODUCT, DEFAULTS["dim_product"])


def catalog_sales(products: DataFrame, events: DataFrame) -> DataFrame:
    """Catalogue items with their number of purchases and revenue, zero when never bought."""
    sold = (
        events.where((F.col("event_type") == "purchase") & F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(F.count("*").alias("purchases"), F.sum("amount").alias("revenue"))
    )
    return products.join(sold, "product_id", "left").withColumns(
        {
            "purchases": F.coalesce("purchases", F.lit(0)),
            "revenue": F.coalesce("revenue", F.lit(0)).cast("decimal(20,2)"),
        }
    )


def dim_user_snapshot(events: DataFrame) -> DataFrame:
    """One open version per user with the attributes of the first event."""
    narrow = events.select("user_id", "event_timestamp", "event_id", "country", "platform")
    first = earliest_per_key(narrow.where(F.col("user_id").isNotNull()), ["user_id"])
    users = first.select(
        "user_id",
        "country",
        F.col("platform").alias("preferred_platform"),
        F.lit(DEFAULT_TIER).alias("user_tier"),
        F.col("event_timestamp").alias("valid_from"),
        open_end().alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    return dense_keys(users, ["user_id"], "user_sk").select("user_sk", *users.columns)

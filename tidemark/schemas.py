"""Declared table schemas, closed vocabularies and column defaults."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The closed vocabularies and defaults of the data model.
EVENT_TYPES = ("signup", "login", "post", "like", "purchase")
PLATFORMS = ("ios", "android", "web")
COUNTRIES = ("US", "CA", "GB", "DE", "IN", "BR", "JP", "FR")
PAYMENT_GATEWAYS = ("stripe", "apple_pay", "google_pay", "meta_pay")
ORDER_STATUSES = ("completed", "refunded", "disputed")
OPEN_END = datetime(9999, 12, 31, 23, 59, 59)
DEFAULT_TIER = "standard"
DEFAULT_GATEWAY = "stripe"
DEFAULT_CURRENCY = "USD"
DEFAULT_ORDER_STATUS = "completed"
DEFAULT_PRODUCT_SK = 1
# Product catalogue: number, category, base price.
PRODUCT_CATALOG = (
    (1, "digital_goods", "4.99"),
    (2, "digital_goods", "9.99"),
    (3, "subscription", "14.99"),
    (4, "merchandise", "29.99"),
    (5, "digital_goods", "1.99"),
    (6, "tipping", "5.00"),
    (7, "creator_pass", "19.99"),
    (8, "verified_badge", "11.99"),
    (9, "promoted_post", "50.00"),
    (10, "ad_credit", "100.00"),
)

# Longest text allowed per staged column.
MAX_LENGTHS = {
    "user_id": 32,
    "event_type": 32,
    "platform": 16,
    "country": 4,
    "product_id": 32,
    "session_id": 64,
}
UUID_PATTERN = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"

MONEY = T.DecimalType(10, 2)


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "smallint": T.ShortType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(10,2)": MONEY,
}


def _schema(columns: str) -> T.StructType:
    # StructType.fromDDL needs a running session, which importing must not.
    pairs = (item.strip().split(" ") for item in columns.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# One line of the event lake, before any cast. Metadata stays JSON text.
RAW_EVENT = _schema(
    "event_id string, user_id string, event_type string, event_timestamp string, "
    "event_date string, platform string, country string, product_id string, "
    "amount double, session_id string, metadata string"
)

# Timestamps are zone-free values that always hold UTC, so no result depends on
# the session time zone.
STAGED_EVENT = _schema(
    "event_id string, user_id string, event_type string, event_timestamp timestamp_ntz, "
    "event_date date, platform string, country string, product_id string, "
    "amount decimal(10,2), session_id string, metadata string"
)

DIM_DATE = _schema(
    "date_id int, calendar_date date, year smallint, quarter smallint, month smallint, "
    "month_name string, day_of_month smallint, day_of_week smallint, day_name string, "
    "week_of_year smallint, is_weekend boolean, is_holiday boolean"
)

DIM_USER = _schema(
    "user_sk bigint, user_id string, country string, preferred_platform string, "
    "user_tier string, signup_channel string, valid_from timestamp_ntz, "
    "valid_to timestamp_ntz, is_current boolean"
)

DIM_PRODUCT = _schema(
    "product_sk int, product_id string, product_name string, category string, "
    "base_price decimal(10,2), currency string, is_active boolean"
)

FACT_EVENTS = _schema(
    "event_sk bigint, event_id string, event_timestamp timestamp_ntz, event_date date, "
    "user_sk bigint, user_id string, platform string, country string, event_type string, "
    "session_id string, metadata string"
)

FACT_ORDERS = _schema(
    "order_sk bigint, order_id string, event_id string, order_timestamp timestamp_ntz, "
    "order_date date, user_sk bigint, user_id string, product_sk int, "
    "order_amount decimal(10,2), currency string, payment_gateway string, order_status string"
)

# Defaults a table fills in when a load leaves the column out or NULL.
DEFAULTS: dict[str, dict[str, object]] = {
    "dim_user": {"user_tier": DEFAULT_TIER, "valid_to": OPEN_END, "is_current": True},
    "dim_date": {"is_holiday": False},
    "dim_product": {"currency": DEFAULT_CURRENCY, "is_active": True},
    "fact_orders": {"currency": DEFAULT_CURRENCY, "order_status": DEFAULT_ORDER_STATUS},
}


def open_end() -> Column:
    """The far-future end of a version that is still valid."""
    return F.lit(OPEN_END.isoformat(sep=" ")).cast("timestamp_ntz")


def conform(
    df: DataFrame,
    schema: T.StructType,
    defaults: dict[str, object] | None = None,
    load_ts: Column | None = None,
) -> DataFrame:
    """Order, cast and default ``df`` so that it has exactly the columns of ``schema``.

    A column that is missing or NULL takes its default, else NULL. ``load_ts``
    adds a ``created_at`` stamp; it is left out otherwise so reruns stay equal.
    """
    defaults = defaults or {}
    present = set(df.columns)
    out = []
    for field in schema.fields:
        value = F.col(field.name) if field.name in present else F.lit(None)
        if field.name in defaults:
            default = defaults[field.name]
            if isinstance(default, datetime):
                fallback = F.lit(default.isoformat(sep=" "))
            else:
                fallback = F.lit(default)
            value = F.coalesce(value.cast(field.dataType), fallback.cast(field.dataType))
        out.append(value.cast(field.dataType).alias(field.name))
    if load_ts is not None:
        out.append(load_ts.alias("created_at"))
    return df.select(*out)

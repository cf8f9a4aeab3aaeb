"""Inputs of the registered queries, derived from the given tables by plain projections.

The same text runs in Spark and in the SQL check; only the JSON accessor differs.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

AS_OF = date(2024, 1, 30)
RETENTION_AS_OF = date(2024, 2, 29)
ORDERS_AS_OF = date(2030, 1, 1)

EVENTS = """
SELECT event_id,
  'USR_' || lpad(CAST(user_id AS VARCHAR(20)), 7, '0') AS user_id,
  CASE event_type WHEN 'view' THEN 'login' WHEN 'click' THEN 'like' WHEN 'error' THEN 'post'
       ELSE event_type END AS event_type,
  ts AS event_timestamp,
  CAST(ts AS DATE) AS event_date,
  CASE CASE WHEN k < 15 THEN k % 3 ELSE user_id % 3 END
       WHEN 0 THEN 'ios' WHEN 1 THEN 'android' ELSE 'web' END AS platform,
  CASE user_id % 4 WHEN 0 THEN 'US' WHEN 1 THEN 'IN' WHEN 2 THEN 'GB' ELSE 'BR' END AS country,
  CASE WHEN event_type = 'purchase'
       THEN 'PRD_' || lpad(CAST(1 + k % 10 AS VARCHAR(20)), 4, '0') END AS product_id,
  CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(10,2))
       ELSE CAST(0 AS DECIMAL(10,2)) END AS amount,
  'SES_' || CAST(1000000 + user_id * 100 + k AS VARCHAR(20)) AS session_id,
  CASE WHEN event_type = 'purchase' AND k % 5 < 4
       THEN '{{"client_version":"v14.2.0","payment_gateway":"' ||
            CASE k % 5 WHEN 0 THEN 'stripe' WHEN 1 THEN 'apple_pay' WHEN 2 THEN 'google_pay'
                       ELSE 'meta_pay' END || '"}}'
       ELSE '{{"client_version":"v15.0.0"}}' END AS metadata
FROM (SELECT *, CAST({js} AS INT) AS k FROM {events}) AS e
"""

_DIRTY_COLUMNS = """
  event_id,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE user_id END AS user_id,
  CASE WHEN event_id % 89 = 0 THEN 'share' ELSE event_type END AS event_type,
  event_timestamp, event_date,
  CASE WHEN event_id % 79 = 0 THEN 'tv' ELSE platform END AS platform,
  CASE WHEN event_id % 83 = 0 THEN CAST(-1 AS DECIMAL(10,2)) ELSE amount END AS amount
"""

# All events with injected faults, plus clean copies of some as duplicates.
DIRTY = f"""
SELECT {_DIRTY_COLUMNS} FROM {{events}}
UNION ALL
SELECT event_id, user_id, event_type, event_timestamp, event_date, platform, amount
FROM {{events}} WHERE event_id % 101 = 0
"""

STRANGERS = """
SELECT event_id, CASE WHEN event_id % 97 = 0 THEN user_id || 'X' ELSE user_id END AS user_id,
       event_type, event_timestamp, event_date, platform, country
FROM {events}
"""

# Text as a foreign writer may leave it; ``date`` is the folder.
DIRTY_LAKE = """
SELECT CAST(event_id AS VARCHAR(20)) AS event_id, user_id,
  CASE WHEN event_id % 89 = 0 THEN NULL ELSE event_type END AS event_type,
  CASE WHEN event_id % 83 = 0 THEN 'noon' WHEN event_id % 79 = 0 THEN NULL
       ELSE CAST(event_date AS VARCHAR(10)) || 'T12:00:00Z' END AS event_timestamp,
  CASE WHEN event_id % 101 = 0 THEN '2024-13-45' WHEN event_id % 97 = 0 THEN '2023-06-01'
       WHEN event_id % 103 = 0 THEN NULL ELSE CAST(event_date AS VARCHAR(10)) END AS event_date,
  event_date AS date,
  CASE WHEN event_id % 71 = 0 THEN CAST(250000000 AS DOUBLE)
       WHEN event_id % 73 = 0 THEN CAST('NaN' AS DOUBLE)
       ELSE CAST(amount AS DOUBLE) END AS amount
FROM {events}
"""

# A nested document per event; its keys hold dots, its numbers final zeros and exponents.
CLIENT_DOCUMENTS = """
SELECT event_id, '{{"client":{{"os.name":"' || platform || '","build":' ||
    CASE event_id % 4 WHEN 0 THEN '3' WHEN 1 THEN '3.00' WHEN 2 THEN '30e-1' ELSE '"3"' END ||
    CASE WHEN event_id % 3 = 0 THEN ',"beta":null' WHEN event_id % 3 = 1 THEN ',"beta":false' ELSE '' END ||
    '}},"tags":[' || CASE WHEN event_type = 'purchase' THEN '"paid",' ELSE '' END || metadata_tag || ',7],' ||
    '"cart":{{"lines":[{{"price":' || CASE event_id % 5 WHEN 0 THEN '1' WHEN 1 THEN '1.01' ELSE '0.5' END ||
    '}},{{"price":2}}]}},"path":[["y","x"],[' || CASE event_id % 2 WHEN 0 THEN '[3,2],1' ELSE '[1],2' END || ']]}}' AS doc
FROM (SELECT *, '{{"gateway":"' || CASE event_id % 2 WHEN 0 THEN 'stripe' ELSE 'meta_pay' END || '"}}' AS metadata_tag
      FROM {events}) AS tagged
"""

USERDAY = """
SELECT event_id, user_id || '#' || CAST(event_date AS VARCHAR(10)) AS user_id,
       event_type, event_timestamp
FROM {events}
"""

CUSTOMER_ORDERS = """
SELECT o_custkey AS user_id, CAST(o_orderdate AS DATE) AS event_date FROM {orders}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _derive(source: DataFrame, text: str) -> DataFrame:
    """Run ``text``, which reads ``SOURCE``, over a DataFrame; braces in it are plain text."""
    escaped = text.replace("{", "{{").replace("}", "}}").replace("SOURCE", "{source}")
    return source.sparkSession.sql(escaped, source=source)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed interaction events."""
    text = EVENTS.format(js="get_json_object(props, '$.k')", events="SOURCE")
    return _derive(table(spark, sf_dir, "events"), text)


def dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with missing users, unknown types and platforms, negative amounts, duplicates."""
    return _derive(events(spark, sf_dir), DIRTY.format(events="SOURCE"))


def strangers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events, some of them by users whom nobody has seen."""
    return _derive(events(spark, sf_dir), STRANGERS.format(events="SOURCE"))


def dirty_lake_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lake rows with values that staging cannot hold."""
    return _derive(events(spark, sf_dir), DIRTY_LAKE.format(events="SOURCE"))


def client_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested JSON document per event."""
    return _derive(events(spark, sf_dir), CLIENT_DOCUMENTS.format(events="SOURCE"))


def user_day_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events keyed by user and day, where most keys do not finish the funnel."""
    return _derive(events(spark, sf_dir), USERDAY.format(events="SOURCE"))


def customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as users and order days as activity: long history, small cohorts."""
    return _derive(table(spark, sf_dir, "orders"), CUSTOMER_ORDERS.format(orders="SOURCE"))


# The same inputs as common table expressions of the SQL check.
SQL_EVENTS = "ev AS (" + EVENTS.format(js="props->>'$.k'", events="events") + ")"
SQL_DIRTY = "dirty AS (" + DIRTY.format(events="ev") + ")"
SQL_STRANGERS = "seen AS (" + STRANGERS.format(events="ev") + ")"
SQL_DIRTY_LAKE = "lake AS (" + DIRTY_LAKE.format(events="ev") + ")"
SQL_USERDAY = "ud AS (" + USERDAY.format(events="ev") + ")"
SQL_ORDERS = "co AS (" + CUSTOMER_ORDERS.format(orders="orders") + ")"

"""Plain SQL for each registered query, written the direct way rather than the scalable one."""

from __future__ import annotations

from workload.fixtures import (
    AS_OF,
    ORDERS_AS_OF,
    RETENTION_AS_OF,
    SQL_DIRTY,
    SQL_DIRTY_LAKE,
    SQL_EVENTS,
    SQL_ORDERS,
    SQL_STRANGERS,
    SQL_USERDAY,
)
from workload.queries import AS_OF_DAYS, DRIFT, FRESH_AT, LAST_DAY

# Written out here again, so that a wrong step or bound in the library shows.
FUNNEL_STEPS = (
    ("signup", ("signup",)),
    ("login", ("login",)),
    ("post_or_like", ("post", "like")),
    ("purchase", ("purchase",)),
)


def _history(source: str, name: str) -> str:
    """Type-2 versions of ``source`` as the CTE ``name``."""
    return f"""
{name}_daily AS (
  SELECT user_id, event_date, country, platform, event_timestamp AS seen_at
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_date
                                     ORDER BY event_timestamp DESC, event_id DESC) AS place
        FROM {source}) AS t
  WHERE place = 1),
{name}_flagged AS (
  SELECT *, LAG(seen_at) OVER w AS prior_at, LAG(country) OVER w AS prior_country,
         LAG(platform) OVER w AS prior_platform
  FROM {name}_daily WINDOW w AS (PARTITION BY user_id ORDER BY event_date)),
{name}_starts AS (
  SELECT * FROM {name}_flagged
  WHERE prior_at IS NULL OR country <> prior_country OR platform <> prior_platform),
{name} AS (
  SELECT ROW_NUMBER() OVER (ORDER BY seen_at, user_id) AS user_sk, user_id, country,
         platform AS preferred_platform, 'standard' AS user_tier, seen_at AS valid_from,
         LEAD(seen_at) OVER (PARTITION BY user_id ORDER BY event_date) AS valid_to,
         LEAD(seen_at) OVER (PARTITION BY user_id ORDER BY event_date) IS NULL AS is_current
  FROM {name}_starts)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_EV = _with(SQL_EVENTS)
_EV_DIRTY = _with(SQL_EVENTS, SQL_DIRTY)
_HIST = _with(SQL_EVENTS, _history("ev", "hist"))
_HIST_STRANGERS = _with(SQL_EVENTS, SQL_STRANGERS, _history("ev", "hist"))
_PIT = "ev.user_id = h.user_id AND event_timestamp >= valid_from AND (valid_to IS NULL OR event_timestamp < valid_to)"
_SNAP = """
snap AS (
  SELECT ROW_NUMBER() OVER (ORDER BY user_id) AS user_sk, user_id, country,
         platform AS preferred_platform, 'standard' AS user_tier,
         event_timestamp AS valid_from, TRUE AS is_current
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id
                                     ORDER BY event_timestamp, event_id) AS place
        FROM ev) AS t
  WHERE place = 1)"""
_SOLD_SNAP = """
sold AS (
  SELECT user_sk, 'ORD_' || CAST(event_id AS VARCHAR) AS order_id, event_date AS order_date,
         CAST(amount AS DOUBLE) AS order_amount
  FROM ev JOIN snap USING (user_id) WHERE event_type = 'purchase' AND amount > 0)"""
_ACTIVITY = f"""
recent AS (SELECT * FROM ev WHERE event_date >= DATE '{AS_OF}' - INTERVAL '30 days'),
counted AS (
  SELECT user_id, COUNT(*) AS total_events, COUNT(DISTINCT event_date) AS active_days,
         COUNT(*) FILTER (event_type = 'post') AS post_count,
         COUNT(*) FILTER (event_type = 'like') AS like_count,
         COUNT(*) FILTER (event_type = 'purchase') AS purchase_count,
         COALESCE(SUM(amount) FILTER (event_type = 'purchase' AND amount > 0), 0) AS total_spend,
         MAX(event_timestamp) AS last_active_at
  FROM recent GROUP BY user_id),
activity AS (
  SELECT counted.*, country, preferred_platform
  FROM counted JOIN hist USING (user_id) WHERE is_current),
placed AS (
  SELECT *, PERCENT_RANK() OVER (ORDER BY total_events DESC) AS pr,
         NTILE(10) OVER (ORDER BY total_events DESC, user_id) AS activity_decile
  FROM activity),
tiered AS (
  SELECT *, CASE WHEN pr <= 0.05 THEN '1_POWER_CREATOR' WHEN pr <= 0.20 THEN '2_CORE_ENGAGER'
                 WHEN pr <= 0.60 THEN '3_CASUAL_CONSUMER' ELSE '4_LIGHT_USER' END AS user_tier
  FROM placed)"""
_ACTIVE = _with(SQL_EVENTS, _history("ev", "hist"), _ACTIVITY)


def _pct(part: str, whole: str) -> str:
    return f"floor(CAST({part} AS DOUBLE) / NULLIF({whole}, 0) * 10000 + 0.5) / 100"


_OFFSETS = (1, 7, 14, 30)


def _retention(source: str, as_of: object) -> str:
    kept = ", ".join(
        f"COUNT(DISTINCT user_id) FILTER (event_date = cohort_date + {k}) AS retained_d{k}"
        for k in _OFFSETS
    )
    shares = ", ".join(
        f"{_pct(f'retained_d{k}', 'cohort_size')} AS d{k}_retention_pct" for k in _OFFSETS
    )
    return f"""
placed AS (SELECT user_id, event_date, MIN(event_date) OVER (PARTITION BY user_id) AS cohort_date
           FROM {source}),
cohorts AS (SELECT cohort_date, COUNT(DISTINCT user_id) AS cohort_size, {kept}
            FROM placed GROUP BY cohort_date),
shares AS (SELECT cohort_date, cohort_size, {shares}
           FROM cohorts WHERE cohort_date <= DATE '{as_of}' - INTERVAL '30 days')"""


_MAU = f"""
spine AS (SELECT CAST(d AS DATE) AS metric_date
          FROM generate_series(DATE '{AS_OF}' - INTERVAL '60 days', TIMESTAMP '{AS_OF}',
                               INTERVAL '1 day') AS s(d)),
user_days AS (SELECT DISTINCT user_id, event_date FROM ev),
mau AS (SELECT metric_date, COUNT(DISTINCT user_id) AS mau
        FROM spine, user_days
        WHERE event_date <= metric_date AND event_date > metric_date - 30
        GROUP BY metric_date)"""

_STICKINESS = f""", ratios AS (
  SELECT metric_date, mau,
         (SELECT COUNT(*) FROM user_days WHERE event_date = metric_date) AS dau
  FROM mau)
SELECT metric_date, dau, mau, {_pct('dau', 'mau')} AS stickiness_ratio_pct,
       floor(AVG(CAST(dau AS DOUBLE) / NULLIF(mau, 0) * 100)
             OVER (ORDER BY metric_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
             * 100 + 0.5) / 100 AS stickiness_7d_ma
FROM ratios"""
_FACTS = f"facts AS (SELECT ev.user_id, event_date FROM ev JOIN hist AS h ON {_PIT})"

# Each step time is a conditional minimum over all rows of the key.
_STEP = """
{name} AS (SELECT *, MIN(CASE WHEN event_type IN ({types}) AND event_timestamp >= {after}
                              THEN event_timestamp END) OVER (PARTITION BY user_id) AS {name}_time
           FROM {source})"""


def _funnel() -> str:
    ctes, source, after = [], "ud", "TIMESTAMP '1900-01-01'"
    for name, types in FUNNEL_STEPS:
        listed = ", ".join(f"'{t}'" for t in types)
        ctes.append(_STEP.format(name=name, types=listed, after=after, source=source))
        source, after = name, f"{name}_time"
    times = ", ".join(f"{name}_time" for name, _ in FUNNEL_STEPS)
    first = FUNNEL_STEPS[0][0]
    ctes.append(
        f"reached AS (SELECT DISTINCT user_id, {times} FROM {source} WHERE {first}_time IS NOT NULL)"
    )
    return ",".join(ctes)


_FUNNEL = _funnel()
_REACHED = " UNION ALL ".join(
    f"SELECT '{i}_{name}' AS stage_name, {i} AS step_order, COUNT({name}_time) AS users_reached "
    "FROM reached"
    for i, (name, _) in enumerate(FUNNEL_STEPS, start=1)
)

_RAW = """SELECT CAST(event_id AS VARCHAR) AS event_id, user_id, event_type, event_timestamp,
       event_date, platform, country, product_id, CAST(amount AS DOUBLE) AS amount, session_id,
       metadata
FROM ev"""

def _loaded(last: str = "", name: str = "hist") -> str:
    """Counts and keys of the warehouse tables; keys must be unique per day."""
    return f""", kept AS (
  SELECT ev.*, user_sk FROM ev JOIN {name} AS h ON {_PIT} {last}),
sold AS (SELECT * FROM kept WHERE event_type = 'purchase' AND amount > 0)
SELECT 'fact_events' AS loaded_table, event_date AS day, COUNT(*) AS n,
       CAST(SUM(user_sk) AS BIGINT) AS sk_sum, COUNT(*) AS n_keys, CAST(0 AS DOUBLE) AS amount
FROM kept GROUP BY event_date
UNION ALL
SELECT 'fact_orders', event_date, COUNT(*), CAST(SUM(user_sk) AS BIGINT), COUNT(*),
       CAST(SUM(amount) AS DOUBLE)
FROM sold GROUP BY event_date
UNION ALL
SELECT 'dim_user', CAST(valid_from AS DATE), COUNT(*), CAST(SUM(user_sk) AS BIGINT), COUNT(*),
       CAST(0 AS DOUBLE)
FROM {name} GROUP BY CAST(valid_from AS DATE)"""


def _as_of(day: object, place: int) -> str:
    return f"""SELECT DATE '{day}' AS as_of, user_id, country, preferred_platform, user_tier,
       valid_from, valid_to, is_current FROM hist{place}"""

_ORDER_COLUMNS = """'ORD_' || CAST(ev.event_id AS VARCHAR) AS order_id, ev.event_id,
       event_timestamp AS order_timestamp, event_date AS order_date"""

_FRESHNESS = f"""SELECT newest, age_seconds,
       CASE WHEN age_seconds > 86400 THEN 'error' WHEN age_seconds > 43200 THEN 'warn'
            ELSE 'pass' END AS status
FROM (SELECT MAX(event_timestamp) AS newest,
             (epoch_us(TIMESTAMP '{FRESH_AT}') - epoch_us(MAX(event_timestamp)))
               / 1000000.0::DOUBLE AS age_seconds
      FROM ev) AS t"""

CHECKS: dict[str, str] = {
    "scan_raw_events": _EV + _RAW,
    "parquet_roundtrip": _EV + _RAW,
    "json_roundtrip": _EV
    + """SELECT CAST(event_id AS VARCHAR) AS event_id, user_id, event_type, event_timestamp,
       event_date, platform, country, product_id, CAST(amount AS DOUBLE) AS amount, session_id,
       CASE WHEN event_id % 7 = 0 THEN 'no: json'
            ELSE '{"z": 1.50,' || substr(metadata, 2) END AS metadata
FROM ev""",
    "scan_untyped_product": _EV
    + _RAW.replace("product_id", "CASE WHEN event_type <> 'like' THEN product_id END AS product_id"),
    "lake_one_day": _EV + _RAW + f" WHERE event_date = DATE '{LAST_DAY}'",
    "scan_one_day": _EV
    + f"""SELECT event_id, user_id, event_type, event_timestamp FROM ev
WHERE event_date = DATE '{LAST_DAY}'""",
    "stage_events": _EV
    + """SELECT event_date, event_type, platform, country, COUNT(*) AS n,
       CAST(SUM(amount) AS DOUBLE) AS amount, MIN(event_timestamp) AS first_at,
       MAX(event_timestamp) AS last_at
FROM ev GROUP BY event_date, event_type, platform, country""",
    "conform_schema": _EV
    + """SELECT 'ORD_' || CAST(event_id AS VARCHAR) AS order_id,
       CAST(event_id AS VARCHAR) AS event_id, event_timestamp AS order_timestamp,
       event_date AS order_date, user_id, CAST(amount AS DOUBLE) AS order_amount,
       CASE WHEN event_type = 'like' THEN 'EUR' ELSE 'USD' END AS currency,
       'completed' AS order_status
FROM ev""",
    "partition_inventory": _EV
    + f"""SELECT event_date AS date, 'parquet' AS format,
       COUNT(DISTINCT event_type = 'signup') + CAST(event_date = DATE '{LAST_DAY}' AS BIGINT) AS n_files,
       TRUE AS has_bytes, COUNT(*) AS n_rows
FROM ev GROUP BY event_date
UNION ALL
SELECT event_date, 'json', 1, TRUE, COUNT(*) FROM ev
WHERE event_date = DATE '{LAST_DAY}' GROUP BY event_date""",
    "idempotent_overwrite": _EV
    + f"""SELECT event_date, COUNT(*) AS n, CAST(SUM(amount) AS DOUBLE) AS amount
FROM ev WHERE event_date <> DATE '{LAST_DAY}' GROUP BY event_date""",
    "filter_purchases": _EV
    + """SELECT event_id, user_id, CAST(amount AS DOUBLE) AS amount, product_id
FROM ev WHERE event_type = 'purchase' AND amount > 0""",
    "intraday_range": _EV
    + f"""SELECT event_id, user_id, event_timestamp, session_id FROM ev
WHERE event_timestamp >= TIMESTAMP '{LAST_DAY} 09:00:00'
  AND event_timestamp < TIMESTAMP '{LAST_DAY} 17:00:00'""",
    "user_type_lookup": _EV
    + f"""SELECT user_id, event_id, event_timestamp FROM ev
WHERE event_type = 'like' AND user_id IN
  (SELECT user_id FROM ev WHERE event_type = 'purchase' AND amount > 150)""",
    "session_lookup": _EV
    + """SELECT session_id, user_id, COUNT(*) AS n, MIN(event_timestamp) AS first_at,
       MAX(event_timestamp) AS last_at
FROM ev GROUP BY session_id, user_id""",
    "lookup_session": _EV
    + """SELECT session_id, event_id, event_type, event_timestamp FROM ev
WHERE session_id = (SELECT session_id FROM ev WHERE event_type = 'purchase'
                    ORDER BY event_timestamp DESC, event_id DESC LIMIT 1)""",
    "lookup_user_type": _EV
    + """SELECT user_id, event_id, event_timestamp FROM ev
WHERE event_type = 'like'
  AND user_id = (SELECT user_id FROM ev ORDER BY amount DESC, event_id DESC LIMIT 1)""",
    "lookup_user_orders": _with(SQL_EVENTS, _SNAP, _SOLD_SNAP)
    + f"""SELECT user_sk, order_id, order_date, order_amount FROM sold
WHERE user_sk = (SELECT user_sk FROM sold GROUP BY user_sk ORDER BY COUNT(*) DESC, user_sk LIMIT 1)
  AND order_date BETWEEN DATE '{LAST_DAY}' - 13 AND DATE '{LAST_DAY}'""",
    "json_filter": _EV
    + """SELECT event_id, user_id, metadata FROM ev
WHERE metadata->>'$.payment_gateway' = 'stripe'""",
    # What the documents are made of, not what they say.
    "json_contains": _EV
    + """SELECT event_id,
       platform = 'ios' AND event_id % 4 <> 3 AS by_key,
       event_type = 'purchase' AND event_id % 2 = 0 AS by_items,
       event_id % 5 = 0 AS by_number,
       event_id % 3 = 0 AS by_null,
       event_id % 2 = 0 AS by_depth
FROM ev""",
    "json_extract": _EV
    + """SELECT metadata->>'$.client_version' AS client_version,
       metadata->>'$.payment_gateway' AS payment_gateway, COUNT(*) AS n
FROM ev GROUP BY ALL""",
    "product_sk_parse": _EV
    + "SELECT event_id, CAST(SUBSTR(product_id, 5) AS BIGINT) AS product_sk FROM ev",
    "iso_timestamp_parse": _EV
    + """SELECT event_id, event_timestamp AS exact_at,
       date_trunc('second', event_timestamp) AS second_at FROM ev""",
    "dim_date": _EV
    + """SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_id, CAST(d AS DATE) AS calendar_date,
       year(d) AS year, quarter(d) AS quarter, month(d) AS month, monthname(d) AS month_name,
       day(d) AS day_of_month, isodow(d) AS day_of_week, dayname(d) AS day_name,
       week(d) AS week_of_year, isodow(d) >= 6 AS is_weekend, FALSE AS is_holiday,
       strftime(d, '%Y_%m_%d') AS partition_label
FROM generate_series((SELECT CAST(MIN(event_date) AS TIMESTAMP) FROM ev),
                     (SELECT CAST(MAX(event_date) AS TIMESTAMP) FROM ev),
                     INTERVAL '1 day') AS s(d)""",
    "dim_product": _EV
    + """SELECT p.product_id, p.product_sk, p.category, CAST(p.base_price AS DOUBLE) AS base_price,
       'USD' AS currency, TRUE AS is_active, COUNT(ev.event_id) AS purchases,
       CAST(COALESCE(SUM(ev.amount), 0) AS DOUBLE) AS revenue
FROM (VALUES (1, 'PRD_0001', 'digital_goods', 4.99), (2, 'PRD_0002', 'digital_goods', 9.99),
             (3, 'PRD_0003', 'subscription', 14.99), (4, 'PRD_0004', 'merchandise', 29.99),
             (5, 'PRD_0005', 'digital_goods', 1.99), (6, 'PRD_0006', 'tipping', 5.00),
             (7, 'PRD_0007', 'creator_pass', 19.99), (8, 'PRD_0008', 'verified_badge', 11.99),
             (9, 'PRD_0009', 'promoted_post', 50.00), (10, 'PRD_0010', 'ad_credit', 100.00)
     ) AS p(product_sk, product_id, category, base_price)
LEFT JOIN ev ON ev.product_id = p.product_id AND ev.event_type = 'purchase'
GROUP BY p.product_id, p.product_sk, p.category, p.base_price""",
    "product_lookup": _EV
    + """SELECT event_id, product_id,
       COALESCE(CAST(SUBSTR(product_id, 5) AS BIGINT), 1) AS product_sk FROM ev""",
    "dim_user_snapshot": _with(SQL_EVENTS, _SNAP) + "SELECT * FROM snap",
    "latest_per_user": _EV
    + """SELECT user_id, event_id, event_timestamp, country, platform
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id
                                   ORDER BY event_timestamp DESC, event_id DESC) AS place
      FROM ev) AS t
WHERE place = 1""",
    "active_days": _EV + "SELECT DISTINCT user_id, event_date FROM ev",
    "first_seen": _EV + "SELECT user_id, MIN(event_date) AS cohort_date FROM ev GROUP BY user_id",
    "daily_counts": _EV + "SELECT event_date, COUNT(*) AS n FROM ev GROUP BY event_date",
    "dau": _EV + "SELECT event_date, COUNT(DISTINCT user_id) AS dau FROM ev GROUP BY event_date",
    "surrogate_keys": _EV
    + """SELECT event_id, event_timestamp, user_id,
       ROW_NUMBER() OVER (ORDER BY event_timestamp, event_id) AS event_sk
FROM ev""",
    "mau_trailing": _with(SQL_EVENTS, _MAU) + "SELECT metric_date, mau FROM mau",
    "dau_mau": _with(SQL_EVENTS, _MAU) + _STICKINESS,
    # Only events that have a user version at their time are facts.
    "dau_mau_kept_words": _with(SQL_EVENTS, _history("ev", "hist"), _FACTS, _MAU.replace("FROM ev", "FROM facts"))
    + _STICKINESS,
    "retention_kept_words": _with(
        SQL_EVENTS, _history("ev", "hist"), _FACTS, _retention("facts", RETENTION_AS_OF)
    )
    + "SELECT * FROM shares",
    "retention_counts": _with(SQL_ORDERS, _retention("co", ORDERS_AS_OF))
    + "SELECT * FROM cohorts",
    "retention_cohorts": _with(SQL_EVENTS, _retention("ev", RETENTION_AS_OF))
    + "SELECT * FROM shares",
    "retention_cohorts_sparse": _with(SQL_ORDERS, _retention("co", ORDERS_AS_OF))
    + "SELECT * FROM shares",
    "funnel_step_times": _with(SQL_EVENTS, SQL_USERDAY, _FUNNEL) + "SELECT * FROM reached",
    "conversion_funnel": _with(SQL_EVENTS, SQL_USERDAY, _FUNNEL)
    + f""", steps AS ({_REACHED}),
chained AS (
  SELECT here.*, prior.users_reached AS before, opening.users_reached AS top
  FROM steps AS here
  LEFT JOIN steps AS prior ON prior.step_order = here.step_order - 1
  JOIN steps AS opening ON opening.step_order = 1)
SELECT stage_name, step_order, users_reached,
       {_pct('users_reached', 'before')} AS step_conversion_pct,
       floor((100.0 - CAST(users_reached AS DOUBLE) / NULLIF(before, 0) * 100) * 100 + 0.5) / 100
         AS step_dropoff_pct,
       {_pct('users_reached', 'top')} AS funnel_conversion_pct
FROM chained""",
    "user_activity": _ACTIVE
    + """SELECT user_id, country, preferred_platform, total_events, active_days, post_count,
       like_count, purchase_count, CAST(total_spend AS DOUBLE) AS total_spend, last_active_at
FROM activity""",
    "user_deciles": _ACTIVE
    + """SELECT user_id, total_events, pr AS activity_percentile_rank, activity_decile, user_tier
FROM tiered""",
    "user_segmentation": _ACTIVE
    + f"""SELECT user_tier, COUNT(user_id) AS total_users,
       {_pct('COUNT(user_id)', 'SUM(COUNT(user_id)) OVER ()')} AS pct_of_userbase,
       floor(AVG(total_events) * 10 + 0.5) / 10 AS avg_events_per_user,
       floor(AVG(active_days) * 10 + 0.5) / 10 AS avg_active_days_30d,
       floor(AVG(post_count) * 10 + 0.5) / 10 AS avg_posts,
       floor(AVG(like_count) * 10 + 0.5) / 10 AS avg_likes,
       CAST(SUM(total_spend) AS DOUBLE) AS tier_total_revenue,
       {_pct('SUM(total_spend)', 'CAST(SUM(SUM(total_spend)) OVER () AS DOUBLE)')}
         AS pct_of_total_revenue
FROM tiered GROUP BY user_tier""",
    "scd2_history": _HIST + "SELECT * FROM hist",
    "scd2_first_event_start": _HIST
    + """SELECT hist.user_id, country, preferred_platform, user_tier,
       CASE WHEN valid_from = MIN(valid_from) OVER (PARTITION BY hist.user_id)
            THEN f.seen_at ELSE valid_from END AS valid_from, valid_to, is_current
FROM hist JOIN (SELECT user_id, MIN(event_timestamp) AS seen_at FROM ev GROUP BY user_id) AS f
  ON hist.user_id = f.user_id""",
    "scd2_closed": _HIST
    + """SELECT user_id, country, preferred_platform, user_tier, valid_from, valid_to
FROM hist WHERE NOT is_current""",
    "current_users": _HIST
    + """SELECT user_id, country, preferred_platform, user_tier, valid_from
FROM hist WHERE is_current""",
    "scd2_merge_batch": _HIST + "SELECT * FROM hist",
    "new_users_anti": _HIST_STRANGERS
    + """, later AS (
  SELECT user_id, event_timestamp AS seen_at, country, platform AS preferred_platform,
         ROW_NUMBER() OVER (PARTITION BY user_id
                            ORDER BY event_timestamp DESC, event_id DESC) AS place
  FROM seen)
SELECT user_id, seen_at, country, preferred_platform FROM later
WHERE place = 1 AND user_id NOT IN (SELECT user_id FROM hist WHERE is_current)""",
    "pit_join": _HIST
    + f"""SELECT event_id, ev.user_id, event_timestamp, user_sk, preferred_platform
FROM ev JOIN hist AS h ON {_PIT}""",
    "load_fact_events": _HIST
    + f"""SELECT event_id, event_timestamp, event_date, user_sk, ev.user_id, platform, ev.country,
       event_type, session_id, metadata
FROM ev JOIN hist AS h ON {_PIT}""",
    "fact_keys": _HIST
    + f"""SELECT event_date, COUNT(*) AS n, COUNT(*) AS n_keys, COUNT(*) AS n_same
FROM ev JOIN hist AS h ON {_PIT} GROUP BY event_date""",
    "completed_orders": _HIST
    + f"""SELECT user_sk, event_date AS order_date, COUNT(*) AS n,
       CAST(SUM(amount) AS DOUBLE) AS amount
FROM ev JOIN hist AS h ON {_PIT}
WHERE event_type = 'purchase' AND amount > 0 AND event_id % 10 <> 0
GROUP BY user_sk, event_date""",
    "load_fact_orders": _HIST
    + f"""SELECT {_ORDER_COLUMNS}, user_sk, ev.user_id,
       CAST(SUBSTR(product_id, 5) AS BIGINT) AS product_sk,
       CAST(amount AS DOUBLE) AS order_amount, 'USD' AS currency,
       COALESCE(metadata->>'$.payment_gateway', 'stripe') AS payment_gateway,
       'completed' AS order_status
FROM ev JOIN hist AS h ON {_PIT}
WHERE event_type = 'purchase' AND amount > 0""",
    "facts_snapshot_join": _with(SQL_EVENTS, _SNAP)
    + """SELECT event_id, event_timestamp, event_date, user_sk, ev.user_id, platform, ev.country,
       event_type, session_id, metadata,
       ROW_NUMBER() OVER (ORDER BY event_timestamp, event_id) AS event_sk
FROM ev JOIN snap ON ev.user_id = snap.user_id""",
    "orders_snapshot": _with(SQL_EVENTS, _SNAP)
    + f"""SELECT {_ORDER_COLUMNS}, user_sk, ev.user_id,
       CAST(SUBSTR(product_id, 5) AS BIGINT) AS product_sk,
       CAST(amount AS DOUBLE) AS order_amount, 'USD' AS currency,
       metadata->>'$.payment_gateway' AS payment_gateway, 'completed' AS order_status,
       ROW_NUMBER() OVER (ORDER BY event_timestamp, event_id) AS order_sk
FROM ev JOIN snap ON ev.user_id = snap.user_id
WHERE event_type = 'purchase' AND amount > 0""",
    "daily_load": _HIST + _loaded(),
    "daily_load_after_rebuild": _HIST + _loaded(),
    "empty_day_rerun": _with(
        SQL_EVENTS,
        "early AS (SELECT * FROM ev WHERE event_date < (SELECT MAX(event_date) FROM ev))",
        _history("early", "hist"),
    )
    + _loaded("WHERE event_date < (SELECT MAX(event_date) FROM ev)"),
    "dim_user_as_of": _with(
        SQL_EVENTS,
        *(
            part
            for i, day in enumerate(AS_OF_DAYS)
            for part in (
                f"ev{i} AS (SELECT * FROM ev WHERE event_date <= DATE '{day}')",
                _history(f"ev{i}", f"hist{i}"),
            )
        ),
    )
    + " UNION ALL ".join(_as_of(day, i) for i, day in enumerate(AS_OF_DAYS)),
    "activity_of_loaded_tables": _ACTIVE.replace(
        "FROM ev WHERE", f"FROM (SELECT ev.* FROM ev JOIN hist AS h ON {_PIT}) AS ev WHERE"
    )
    + """SELECT user_id, country, preferred_platform, total_events, active_days, post_count,
       like_count, purchase_count, CAST(total_spend AS DOUBLE) AS total_spend, last_active_at
FROM activity""",
    "dq_rejected_rows": _with(SQL_EVENTS, SQL_DIRTY_LAKE)
    + """, typed AS (
  SELECT *, try_cast(event_date AS DATE) AS d,
         try_cast(replace(event_timestamp, 'Z', '') AS TIMESTAMP) AS seen_at FROM lake)
SELECT 'event_date' AS reason, COUNT(*) FILTER (d IS NULL) AS failing_rows FROM typed
UNION ALL SELECT 'event_date_unlike_folder', COUNT(*) FILTER (d <> date) FROM typed
UNION ALL SELECT 'event_timestamp', COUNT(*) FILTER (seen_at IS NULL) FROM typed
UNION ALL SELECT 'time_outside_day', COUNT(*) FILTER (CAST(seen_at AS DATE) <> d) FROM typed
UNION ALL SELECT 'amount', COUNT(*) FILTER (amount = 250000000 OR isnan(amount)) FROM typed
UNION ALL SELECT 'event_type', COUNT(*) FILTER (event_type IS NULL) FROM typed""",
    "dq_not_null": _EV_DIRTY
    + " UNION ALL ".join(
        f"SELECT 'not_null: {c}' AS \"check\", COUNT(*) FILTER ({c} IS NULL) = 0 AS passed, "
        f"COUNT(*) FILTER ({c} IS NULL) AS failing_rows FROM dirty"
        for c in ("event_id", "user_id", "event_type", "event_timestamp", "event_date", "platform")
    ),
    "file_not_null": _EV_DIRTY
    + " UNION ALL ".join(
        f"SELECT 'not_null: {c}' AS \"check\", COUNT(*) FILTER ({c} IS NULL) = 0 AS passed, "
        f"COUNT(*) FILTER ({c} IS NULL) AS failing_rows FROM dirty"
        for c in ("event_id", "user_id", "event_type", "event_timestamp")
    ),
    "file_freshness": _EV + _FRESHNESS,
    "rejected_records": _EV
    + """SELECT event_date AS date, 'corrupt_line,event_date,event_timestamp,event_type' AS reasons,
       '{"event_id":"' || event_id || '","user_id":' AS record
FROM ev WHERE event_id % 97 = 0
UNION ALL
SELECT event_date, CASE WHEN event_id % 89 = 0 THEN 'amount,event_type'
                        ELSE 'amount' END, CAST(event_id AS VARCHAR)
FROM ev WHERE event_id % 83 = 0
UNION ALL
SELECT event_date, 'event_type', CAST(event_id AS VARCHAR)
FROM ev WHERE event_id % 89 = 0 AND event_id % 83 <> 0""",
    "compacted_lake": _EV
    + """SELECT event_date AS date, 4 AS n_before, 1 AS n_after, COUNT(*) AS n,
       CAST(SUM(amount) AS DOUBLE) AS amount
FROM ev GROUP BY event_date""",
    "dq_unique": _EV_DIRTY
    + """SELECT event_date, event_id, COUNT(*) AS n FROM dirty
GROUP BY event_date, event_id HAVING COUNT(*) > 1""",
    "dq_unique_null_as_value": _EV_DIRTY
    + "SELECT user_id, COUNT(*) AS n FROM dirty GROUP BY user_id HAVING COUNT(*) > 1",
    "dq_duplicates": _EV_DIRTY
    + """SELECT 'event_id' AS key, COUNT(*) - COUNT(DISTINCT event_id) AS duplicates FROM dirty
UNION ALL SELECT 'user_id', COUNT(*) - COUNT(DISTINCT user_id) FROM dirty""",
    "dq_accepted_values": _EV_DIRTY
    + """SELECT 'event_type' AS field, event_type AS value, COUNT(*) AS n FROM dirty
WHERE event_type NOT IN ('signup', 'login', 'post', 'like', 'purchase') GROUP BY event_type
UNION ALL
SELECT 'platform', platform, COUNT(*) FROM dirty
WHERE platform NOT IN ('ios', 'android', 'web') GROUP BY platform""",
    "dq_relationships": _HIST_STRANGERS
    + """SELECT user_id, COUNT(*) AS n FROM seen
WHERE user_id NOT IN (SELECT user_id FROM hist WHERE is_current) GROUP BY user_id""",
    "dq_range": _EV_DIRTY
    + """SELECT event_id, event_date, CAST(amount AS DOUBLE) AS amount FROM dirty
WHERE NOT (amount >= 0)""",
    "dq_freshness": _EV + _FRESHNESS,
    "row_count_drift": _EV
    + f""", per_day AS (SELECT event_date, COUNT(*) AS row_count FROM ev GROUP BY event_date),
framed AS (
  SELECT event_date, row_count,
         SUM(row_count) OVER back / CAST(COUNT(*) OVER back AS DOUBLE) AS baseline_7d_avg
  FROM per_day
  WINDOW back AS (ORDER BY event_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT *, ABS(row_count - baseline_7d_avg) / baseline_7d_avg AS drift_ratio
FROM framed WHERE ABS(row_count - baseline_7d_avg) / baseline_7d_avg > {DRIFT}""",
    "dq_suite": _EV_DIRTY
    + """, c AS (
  SELECT COUNT(*) AS total,
         COUNT(*) - COUNT(DISTINCT event_id) AS dup,
         COUNT(*) FILTER (event_id IS NULL) AS n1, COUNT(*) FILTER (user_id IS NULL) AS n2,
         COUNT(*) FILTER (event_type IS NULL) AS n3,
         COUNT(*) FILTER (event_timestamp IS NULL) AS n4,
         COUNT(*) FILTER (event_type IS NULL OR event_type NOT IN
                          ('signup', 'login', 'post', 'like', 'purchase')) AS unexpected,
         COUNT(*) FILTER (amount < 0) AS negative,
         array_to_string(list_sort(list_distinct(list(event_type) FILTER (event_type NOT IN
                          ('signup', 'login', 'post', 'like', 'purchase')))), ', ') AS others
  FROM dirty),
r AS (
  SELECT 'expect_column_values_to_be_unique: event_id' AS "check", dup AS failing_rows, 'Duplicates found: ' || dup AS message FROM c
  UNION ALL SELECT 'expect_column_values_to_not_be_null: event_id', n1, 'Null count in event_id: ' || n1 FROM c
  UNION ALL SELECT 'expect_column_values_to_not_be_null: user_id', n2, 'Null count in user_id: ' || n2 FROM c
  UNION ALL SELECT 'expect_column_values_to_not_be_null: event_type', n3, 'Null count in event_type: ' || n3 FROM c
  UNION ALL SELECT 'expect_column_values_to_not_be_null: event_timestamp', n4, 'Null count in event_timestamp: ' || n4 FROM c
  UNION ALL SELECT 'expect_column_values_to_be_in_set: event_type', unexpected, 'Unexpected event types: {' || others || '}' FROM c
  UNION ALL SELECT 'expect_column_values_to_be_between: amount >= 0', negative, 'Negative amounts detected: ' || negative FROM c)
SELECT 'product_events_core_expectations' AS suite_name, (SELECT total FROM c) AS total_records,
       MAX(failing_rows) OVER () = 0 AS checks_passed, "check", failing_rows = 0 AS passed,
       failing_rows, message
FROM r""",
    "dq_gate": _EV_DIRTY
    + """SELECT COUNT(*) FILTER (user_id IS NULL OR event_timestamp IS NULL) AS missing_required,
       COUNT(*) FILTER (amount < 0) AS negative_amounts,
       COUNT(*) FILTER (event_type NOT IN ('signup', 'login', 'post', 'like', 'purchase'))
         AS unexpected_event_type,
       COUNT(*) FILTER (platform NOT IN ('ios', 'android', 'web')) AS unexpected_platform,
       COUNT(*) - COUNT(DISTINCT event_id) AS duplicate_keys
FROM dirty""",
    "dq_scd2_intervals": _HIST
    + """, spans AS (
  SELECT user_id, is_current, COALESCE(valid_to <= valid_from, FALSE) AS empty,
         COALESCE(LEAD(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from)
                  < COALESCE(valid_to, TIMESTAMP '9999-12-31 23:59:59'), FALSE) AS overlapping
  FROM hist),
t AS (
  SELECT COUNT(*) FILTER (empty) AS e, COUNT(*) FILTER (overlapping) AS o,
         (SELECT COUNT(*) FROM (SELECT user_id FROM spans GROUP BY user_id
                                HAVING COUNT(*) FILTER (is_current) <> 1) AS q) AS c
  FROM spans)
SELECT 'empty_interval' AS "check", e = 0 AS passed, e AS failing_rows FROM t
UNION ALL SELECT 'overlap', o = 0, o FROM t
UNION ALL SELECT 'not_one_current', c = 0, c FROM t""",
    "dq_declared": _with(SQL_EVENTS, SQL_DIRTY, _history("ev", "hist"))
    + f""", kept AS (SELECT ev.*, user_sk, valid_to FROM ev JOIN hist AS h ON {_PIT}),
n AS (SELECT (SELECT COUNT(*) FROM kept WHERE event_id % 97 = 0) AS lost,
             (SELECT COUNT(*) FROM dirty WHERE user_id IS NULL) AS no_user,
             (SELECT COUNT(*) FROM dirty WHERE event_type = 'share') AS bad_type,
             (SELECT COUNT(*) FROM (SELECT event_id FROM dirty GROUP BY event_id
                                    HAVING COUNT(*) > 1) AS r) AS twice),
found AS (
  SELECT r.*, CASE mark WHEN 'lost' THEN lost WHEN 'no_user' THEN no_user
                        WHEN 'bad_type' THEN bad_type WHEN 'twice' THEN twice ELSE 0
              END AS failing_rows
  FROM n, (VALUES
    ('dim_user', 'not_null: user_sk', ''), ('dim_user', 'not_null: user_id', ''),
    ('dim_user', 'not_null: is_current', ''), ('dim_user', 'unique: user_sk', ''),
    ('fact_events', 'not_null: event_id', ''), ('fact_events', 'not_null: user_sk', ''),
    ('fact_events', 'not_null: event_date', ''), ('fact_events', 'accepted_values: platform', ''),
    ('fact_events', 'unique: event_id', ''), ('fact_events', 'unique: event_date, event_id', ''),
    ('fact_events', 'relationships: user_sk', 'lost'),
    ('fact_orders', 'not_null: order_id', ''), ('fact_orders', 'not_null: order_amount', ''),
    ('fact_orders', 'not_negative: order_amount', ''), ('fact_orders', 'unique: order_id', ''),
    ('fact_orders', 'unique: order_date, order_id', ''),
    ('stg_events', 'not_null: event_id', ''), ('stg_events', 'not_null: user_id', 'no_user'),
    ('stg_events', 'not_null: event_type', ''), ('stg_events', 'not_null: event_timestamp', ''),
    ('stg_events', 'accepted_values: event_type', 'bad_type'),
    ('stg_events', 'unique: event_id', 'twice')) AS r(checked_table, "check", mark))
SELECT checked_table, "check", failing_rows = 0 AS passed, failing_rows FROM found""",
    "snapshot_views": _with(SQL_EVENTS, _SNAP)
    + """, numbered AS (
  SELECT ev.*, snap.preferred_platform, event_type = 'purchase' AND amount > 0 AS sold,
         ROW_NUMBER() OVER (ORDER BY event_timestamp, event_id) AS event_sk
  FROM ev JOIN snap ON ev.user_id = snap.user_id)
SELECT event_date AS calendar_date, dayname(event_date) AS day_name, preferred_platform,
       COUNT(*) AS events, COUNT(*) FILTER (sold) AS orders,
       CAST(SUM(amount) FILTER (sold) AS DOUBLE) AS revenue, MAX(event_sk) AS top_sk
FROM numbered GROUP BY event_date, preferred_platform""",
    "dq_text_limits": _EV
    + " UNION ALL ".join(
        f"SELECT '{label}' AS \"check\", COUNT(*) FILTER ({bad}) = 0 AS passed, "
        f"COUNT(*) FILTER ({bad}) AS failing_rows FROM ev"
        for label, bad in (
            ("max_length: user_id", "length(user_id) > 32"),
            ("max_length: event_type", "length(event_type) > 5"),
            ("max_length: platform", "length(platform) > 16"),
            ("max_length: country", "length(country) > 4"),
            ("max_length: product_id", "length(product_id) > 32"),
            ("max_length: session_id", "length(session_id) > 64"),
            ("pattern: event_id", "event_type = 'purchase'"),
        )
    ),
}

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.activity import sliding_distinct
from tidemark.plans import marts
from tidemark.plans.dims import dim_date, dim_product
from tidemark.plans.facts import load_fact_orders, product_lookup
from tidemark.operators.scd2 import scd2_history

DAY0 = datetime.date(2024, 1, 1)


def _day(n):
    return DAY0 + datetime.timedelta(days=n)


@pytest.fixture(scope="module")
def random_activity(spark):
    """Sparse activity of 60 users over 200 days, with gaps, repeats and unknown users."""
    rng = random.Random(7)
    pairs = [(f"u{rng.randrange(60)}", _day(rng.randrange(200))) for _ in range(700)]
    pairs = [p for p in pairs if not 90 <= (p[1] - DAY0).days < 135]
    pairs += pairs[:50] + [(None, _day(3)), ("u1", None)]
    return pairs, spark.createDataFrame(pairs, "user_id string, event_date date")


@pytest.mark.parametrize("days", [1, 7, 30, 75])
def test_sliding_distinct_against_brute_force(random_activity, days):
    pairs, df = random_activity
    first, last = _day(20), _day(190)
    got = {
        r.metric_date: (r.mau, r.dau)
        for r in sliding_distinct(df, first, last, days, daily_name="dau").collect()
    }
    want = {}
    for n in range(20, 191):
        window = {_day(n - back) for back in range(days)}
        users = {u for u, d in pairs if u and d in window}
        if users:
            want[_day(n)] = (len(users), len({u for u, d in pairs if u and d == _day(n)}))
    assert got == want


@pytest.mark.parametrize("offsets", [(1, 7, 14, 30), (0, 59, 60, 61, 119, 150)])
def test_retention_against_brute_force(random_activity, offsets):
    pairs, df = random_activity
    days = {}
    for user, day in pairs:
        if user and day:
            days.setdefault(user, set()).add(day)
    want = {}
    for active in days.values():
        cohort = min(active)
        row = want.setdefault(cohort, [0] * (1 + len(offsets)))
        row[0] += 1
        for i, k in enumerate(offsets):
            row[i + 1] += cohort + datetime.timedelta(days=k) in active
    got = {r[0]: list(r[1:]) for r in marts.retention_counts(df, offsets).collect()}
    assert got == want


def test_days_before_1970_are_counted(spark):
    days = [datetime.date(1969, 12, 31), datetime.date(1970, 1, 1), datetime.date(1970, 1, 7)]
    df = spark.createDataFrame([("u", d) for d in days], "user_id string, event_date date")
    row = marts.retention_counts(df).first()
    assert (row.cohort_date, row.cohort_size, row.retained_d1, row.retained_d7) == (days[0], 1, 1, 1)


def test_immature_cohorts_are_left_out(spark):
    df = spark.createDataFrame(
        [("u", _day(0)), ("v", _day(1))], "user_id string, event_date date"
    )
    rows = marts.retention(df, _day(30)).collect()
    assert [r.cohort_date for r in rows] == [_day(0)]


def test_stickiness_defaults_and_order(spark):
    df = spark.createDataFrame([("u", _day(0)), ("v", _day(2))], "user_id string, event_date date")
    rows = marts.dau_mau(df, _day(3), spine_days=10, mau_days=2).collect()
    assert [(r.metric_date, r.dau, r.mau) for r in rows] == [
        (_day(3), 0, 1),
        (_day(2), 1, 1),
        (_day(1), 0, 1),
        (_day(0), 1, 1),
    ]
    assert [r.stickiness_7d_ma for r in rows] == [50.0, 66.67, 50.0, 100.0]


def test_calendar_limits_the_spine(spark):
    df = spark.createDataFrame([("u", _day(0))], "user_id string, event_date date")
    calendar = dim_date(spark, _day(1), _day(1))
    rows = marts.dau_mau(df, _day(3), calendar=calendar).collect()
    assert [r.metric_date for r in rows] == [_day(1)]


def _funnel(df):
    return [r.users_reached for r in marts.funnel(df).collect()]


def test_same_instant_steps_count(staged):
    at = "2024-01-01 10:00:00"
    rows = staged([("u", k, at) for k in ("purchase", "like", "login", "signup")])
    assert _funnel(rows) == [1, 1, 1, 1]


def test_steps_must_follow_each_other(staged):
    rows = staged(
        [
            ("u", "login", "2024-01-01 10:00:00"),
            ("u", "signup", "2024-01-01 11:00:00"),
            ("u", "post", "2024-01-01 12:00:00"),
            ("v", "signup", "2024-01-01 10:00:00"),
            ("v", "login", "2024-01-01 11:00:00"),
            ("v", "purchase", "2024-01-01 11:30:00"),
            ("v", "like", "2024-01-01 12:00:00"),
            ("w", "login", "2024-01-01 12:00:00"),
            (None, "signup", "2024-01-01 12:00:00"),
        ]
    )
    assert _funnel(rows) == [2, 1, 1, 0]


def test_empty_funnel_has_all_steps(staged):
    rows = marts.funnel(staged([("u", "like", "2024-01-01 10:00:00")])).collect()
    assert [r.users_reached for r in rows] == [0, 0, 0, 0]
    assert rows[1].step_conversion_pct is None


def test_funnel_date_bounds(staged):
    rows = staged(
        [("u", "signup", "2024-01-01 10:00:00"), ("u", "login", "2024-01-02 10:00:00")]
    )
    got = marts.funnel(rows, start=_day(0), end=_day(0)).collect()
    assert [r.users_reached for r in got] == [1, 0, 0, 0]


# One event type counts for two steps, another for none.
STEPS = (("a", ("signup",)), ("b", ("login", "like")), ("c", ("like",)), ("d", ("purchase", "login")))


def _walk(rows, steps):
    """Step times per key, one step after the other over all of a key's events."""
    out = {}
    for user in {u for u, _, _ in rows if u is not None}:
        times, at = [], None
        for _, kinds in steps:
            later = [t for u, k, t in rows if u == user and k in kinds and t is not None and (at is None or t >= at)]
            at = min(later, default=None)
            times.append(at)
            if at is None:
                break
        if times[0] is not None:
            out[user] = tuple(times + [None] * (len(steps) - len(times)))
    return out


@pytest.mark.parametrize("steps", [marts.FUNNEL_STEPS, STEPS, STEPS[:1]])
@pytest.mark.parametrize("slot", ["HOUR", "MINUTE", "SECOND", "DAY"])
def test_funnel_equals_a_walk_over_all_events(spark, steps, slot):
    """A third of the events are one key's, and many share an instant."""
    rng = random.Random(len(steps))
    kinds = ("signup", "login", "post", "like", "purchase")
    start = datetime.datetime(2023, 12, 31, 23, 30)
    rows = []
    for i in range(2_500):
        user = "hot" if i % 3 == 0 else rng.choice([None, *(f"u{n}" for n in range(200))])
        at = start + datetime.timedelta(seconds=rng.randrange(3) * 1800 + rng.randrange(90))
        rows.append((user, rng.choice(kinds), None if i % 97 == 0 else at))
    df = spark.createDataFrame(rows, "user_id string, event_type string, event_timestamp timestamp_ntz")
    got = {r[0]: tuple(r)[1:] for r in marts.funnel_step_times(df, steps, slot=slot).collect()}
    assert got == _walk(rows, steps) and len(got) > 50


def test_funnel_of_times_before_the_epoch(staged):
    times = ["1969-12-31 23:59:59", "1969-12-31 23:30:00", "1970-01-01 00:10:00"]
    rows = staged([("u", k, t) for k, t in zip(("login", "signup", "like"), times, strict=True)])
    assert _funnel(rows) == [1, 1, 1, 0]


def _users(spark, n):
    """Users with tied event counts; the only user of ``n = 1`` spent nothing."""
    return spark.range(n).select(
        F.col("id").cast("string").alias("user_id"),
        (F.col("id") % 7 + 1).alias("total_events"),
        F.lit(1).cast("bigint").alias("active_days"),
        F.col("id").alias("post_count"),
        F.lit(0).cast("bigint").alias("like_count"),
        F.lit(0 if n == 1 else 2).cast("decimal(20,2)").alias("total_spend"),
    )


@pytest.mark.parametrize("n", [1, 4, 25])
def test_summary_agrees_with_the_ranked_users(spark, n):
    users = _users(spark, n)
    per_user = marts.segment_users(users).groupBy("user_tier").count().collect()
    summary = marts.segment_summary(users).collect()
    assert {r.user_tier: r["count"] for r in per_user} == {
        r.user_tier: r.total_users for r in summary
    }
    if n == 1:
        assert (summary[0].user_tier, summary[0].pct_of_userbase) == ("1_POWER_CREATOR", 100.0)
        assert summary[0].pct_of_total_revenue is None


def test_activity_window_and_linking(spark, staged):
    as_of = datetime.date(2024, 3, 1)
    rows = staged(
        [
            ("u", "login", "2024-01-31 10:00:00", {"event_id": "in"}),
            ("u", "login", "2024-01-30 10:00:00", {"event_id": "out"}),
            ("u", "purchase", "2024-03-05 10:00:00", {"event_id": "later", "amount": "3.50"}),
            ("u", None, "2024-02-02 10:00:00", {"event_id": "untyped"}),
            ("x", "login", "2024-02-02 10:00:00", {"event_id": "no version"}),
        ]
    )
    dim = scd2_history(rows.where("user_id = 'u'"), surrogate=None)
    orders = rows.where("event_type = 'purchase'").select(
        "event_id", F.col("event_date").alias("order_date"), F.col("amount").alias("order_amount")
    )
    for kinds in (("purchase",), None):
        (row,) = marts.user_activity(dim, rows, orders, as_of, order_types=kinds).collect()
        assert (row.user_id, row.total_events, row.active_days) == ("u", 3, 3)
        assert (row.purchase_count, float(row.total_spend)) == (1, 3.5)
        assert row.last_active_at.month == 3


def test_default_product_and_gateway(spark, staged):
    rows = staged(
        [
            ("u", "purchase", "2024-01-01 10:00:00",
             {"event_id": "a", "product_id": "PRD_0004", "amount": 1,
              "metadata": '{"payment_gateway":"meta_pay"}'}),
            ("u", "purchase", "2024-01-01 10:00:00", {"event_id": "b", "amount": 2}),
            ("u", "purchase", "2024-01-01 10:00:00",
             {"event_id": "c", "product_id": "PRD_9999", "amount": 3}),
            ("u", "purchase", "2024-01-01 10:00:00", {"event_id": "d", "amount": 0}),
        ]
    )
    products = dim_product(spark)
    found = {r.event_id: r.product_sk for r in product_lookup(rows, products).collect()}
    assert found == {"a": 4, "b": 1, "c": 1, "d": 1}
    orders = load_fact_orders(rows, scd2_history(rows), products).collect()
    assert {(r.order_id, r.payment_gateway) for r in orders} == {
        ("ORD_a", "meta_pay"),
        ("ORD_b", "stripe"),
        ("ORD_c", "stripe"),
    }


def test_calendar_with_holidays(spark):
    holidays = spark.createDataFrame([(_day(0),)], "calendar_date date")
    rows = {r.calendar_date: r for r in dim_date(spark, _day(0), _day(6), holidays).collect()}
    assert len(rows) == 7
    assert rows[_day(0)].is_holiday and not rows[_day(1)].is_holiday
    assert (rows[_day(5)].day_of_week, rows[_day(5)].is_weekend) == (6, True)
    assert rows[_day(0)].date_id == 20240101

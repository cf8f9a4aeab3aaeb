"""The four growth marts. Every mart takes an explicit ``as_of`` day."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import pct, ratio_pct, round_half_up
from tidemark.functions.days import between_days
from tidemark.operators.activity import (
    WORD,
    day_words,
    sliding_distinct,
    sliding_distinct_of_words,
)
from tidemark.operators.keys import percent_rank_of, rank_descending


def dau(events: DataFrame, key: str = "user_id", day: str = "event_date") -> DataFrame:
    """Distinct users per day."""
    return events.groupBy(day).agg(F.count_distinct(F.col(key)).alias("dau"))


def first_seen(events: DataFrame, key: str = "user_id", day: str = "event_date") -> DataFrame:
    """First active day per user."""
    return events.groupBy(key).agg(F.min(day).alias("cohort_date"))


def mau_trailing(
    events: DataFrame,
    as_of: date,
    spine_days: int = 60,
    mau_days: int = 30,
    key: str = "user_id",
    day: str = "event_date",
) -> DataFrame:
    """Distinct users of the trailing ``mau_days`` for each day of the spine."""
    first = as_of - timedelta(days=spine_days)
    return sliding_distinct(events, first, as_of, mau_days, key, day)


def dau_mau(
    events: DataFrame,
    as_of: date,
    spine_days: int = 60,
    mau_days: int = 30,
    ma_rows: int = 7,
    calendar: DataFrame | None = None,
    key: str = "user_id",
    day: str = "event_date",
) -> DataFrame:
    """Stickiness per day, newest first: DAU, MAU, their ratio and its moving average.

    Both counts come from one shuffle of one packed row per user. ``calendar``
    limits the spine to its ``calendar_date`` values; the default is every day.
    """
    first = as_of - timedelta(days=spine_days)
    counts = sliding_distinct(events, first, as_of, mau_days, key, day, daily_name="dau")
    return _stickiness(counts, ma_rows, calendar)


def dau_mau_of_words(
    words: DataFrame,
    as_of: date,
    spine_days: int = 60,
    mau_days: int = 30,
    ma_rows: int = 7,
    calendar: DataFrame | None = None,
    key: str = "user_id",
) -> DataFrame:
    """:func:`dau_mau` from the activity words that the daily load keeps; no event is read."""
    first = as_of - timedelta(days=spine_days)
    counts = sliding_distinct_of_words(words, first, as_of, mau_days, key, daily_name="dau")
    return _stickiness(counts, ma_rows, calendar)


def _stickiness(counts: DataFrame, ma_rows: int, calendar: DataFrame | None) -> DataFrame:
    if calendar is not None:
        spine = calendar.select(F.col("calendar_date").alias("metric_date"))
        counts = counts.join(spine, "metric_date")
    ratio = ratio_pct(F.col("dau"), F.col("mau"))
    # One row per spine day reaches this window.
    recent = W.orderBy("metric_date").rowsBetween(1 - ma_rows, 0)
    return counts.select(
        "metric_date",
        "dau",
        "mau",
        pct(F.col("dau"), F.col("mau")).alias("stickiness_ratio_pct"),
        round_half_up(F.avg(ratio).over(recent), 2).alias("stickiness_7d_ma"),
    ).orderBy(F.col("metric_date").desc())


def retention_counts(
    events: DataFrame,
    offsets: Sequence[int] = (1, 7, 14, 30),
    key: str = "user_id",
    day: str = "event_date",
) -> DataFrame:
    """Cohort size and users active exactly ``k`` days after their first day.

    The second shuffle carries one row per user and word of days instead of one
    per active day, and the per-user window sees only those few rows.
    """
    return retention_counts_of_words(day_words(events.where(F.col(key).isNotNull()), key, day), offsets, key)


def retention_counts_of_words(
    words: DataFrame, offsets: Sequence[int] = (1, 7, 14, 30), key: str = "user_id"
) -> DataFrame:
    """:func:`retention_counts` from the activity words ``(key, word, bits)`` of all days."""
    bits = F.col("bits")
    # Index of the lowest set bit: the zeros below it are set in ``bits - 1`` alone.
    lowest = F.bit_count(F.bitwise_not(bits).bitwiseAND(bits - F.lit(1)))
    base = F.col("word") * F.lit(WORD)
    cohort = F.min(F.col("first_day")).over(W.partitionBy(key))
    packed = (
        words.withColumn("first_day", base + lowest)
        .withColumn("cohort", cohort)
        .withColumn("base", base)
    )

    def active_on(target: Column) -> Column:
        inside = (target >= F.col("base")) & (target < F.col("base") + F.lit(WORD))
        shifted = F.call_function("shiftright", bits, (target - F.col("base")).cast("int"))
        return inside & (shifted.bitwiseAND(F.lit(1)) == F.lit(1))

    return packed.groupBy(F.date_from_unix_date("cohort").alias("cohort_date")).agg(
        F.count_if(F.col("first_day") == F.col("cohort")).alias("cohort_size"),
        *(
            F.count_if(active_on(F.col("cohort") + F.lit(k))).alias(f"retained_d{k}")
            for k in offsets
        ),
    )


def retention(
    events: DataFrame,
    as_of: date,
    offsets: Sequence[int] = (1, 7, 14, 30),
    maturity_days: int = 30,
    key: str = "user_id",
    day: str = "event_date",
) -> DataFrame:
    """Retention percentages of matured cohorts, newest cohort first."""
    return _matured(retention_counts(events, offsets, key, day), as_of, offsets, maturity_days)


def retention_of_words(
    words: DataFrame,
    as_of: date,
    offsets: Sequence[int] = (1, 7, 14, 30),
    maturity_days: int = 30,
    key: str = "user_id",
) -> DataFrame:
    """:func:`retention` from the activity words that the daily load keeps; no event is read."""
    return _matured(retention_counts_of_words(words, offsets, key), as_of, offsets, maturity_days)


def _matured(
    counts: DataFrame, as_of: date, offsets: Sequence[int], maturity_days: int
) -> DataFrame:
    mature = counts.where(F.col("cohort_date") <= F.lit(as_of - timedelta(days=maturity_days)))
    return mature.select(
        "cohort_date",
        "cohort_size",
        *(
            pct(F.col(f"retained_d{k}"), F.col("cohort_size")).alias(f"d{k}_retention_pct")
            for k in offsets
        ),
    ).orderBy(F.col("cohort_date").desc())


# Step label and the event types that satisfy it.
FUNNEL_STEPS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("signup", ("signup",)),
    ("login", ("login",)),
    ("post_or_like", ("post", "like")),
    ("purchase", ("purchase",)),
)


def _slot_steps(rows: DataFrame, steps: Sequence[str], key: str, ts: str) -> DataFrame:
    """Per key and slot a step function: ``r{n}_{j}`` is when step ``j`` is reached in the slot
    by a key that comes into it with ``n`` steps behind it, NULL if it is not.

    Every candidate of a later step is compared with the time of the step before it, so each
    round of windows goes one step further for all ``n`` at once, in one order of the rows.
    """
    within = W.partitionBy(key, "__slot")
    names = []
    for ahead in range(1, len(steps) + 1):
        found = {}
        for n in range(len(steps) - ahead + 1):
            j = n + ahead
            counts = F.col(f"__is_{j}")
            if ahead > 1:
                counts = counts & (F.col(ts) >= F.col(f"r{n}_{j - 1}"))
            found[f"r{n}_{j}"] = F.min(F.when(counts, F.col(ts))).over(within)
        rows = rows.withColumns(found)
        names += found
    return rows.groupBy(key, "__slot").agg(*(F.min(c).alias(c) for c in names))


def funnel_step_times(
    events: DataFrame,
    steps: Sequence[tuple[str, Collection[str]]] = FUNNEL_STEPS,
    key: str = "user_id",
    ts: str = "event_timestamp",
    kind: str = "event_type",
    start: date | None = None,
    end: date | None = None,
    slot: str = "HOUR",
) -> DataFrame:
    """Per key that reached step 1: the time each step was first reached, in order.

    Step ``k + 1`` is the earliest of its events at or after step ``k``; an event
    at the same instant counts, and one event may count for several steps. Events are read
    once and shuffled once, by key and ``slot`` of time (a unit such as HOUR), so that no
    task has more than a slot of a key. What a slot does is a function from the steps reached
    before it to those reached after it; one row per key and slot is then composed in order.
    """
    wanted = sorted({t for _, types in steps for t in types})
    rows = events.where(F.col(kind).isin(wanted) & F.col(key).isNotNull() & F.col(ts).isNotNull())
    if start is not None:
        rows = rows.where(F.col(ts) >= F.lit(str(start)).cast("timestamp_ntz"))
    if end is not None:
        day_after = end + timedelta(days=1)
        rows = rows.where(F.col(ts) < F.lit(str(day_after)).cast("timestamp_ntz"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    names = [name for name, _ in steps]
    narrow = rows.select(
        key,
        ts,
        F.timestamp_diff(slot, epoch, F.col(ts)).alias("__slot"),
        *(F.col(kind).isin(list(t)).alias(f"__is_{j}") for j, (_, t) in enumerate(steps, start=1)),
    )
    slots = _slot_steps(narrow, names, key, ts)
    functions = [c for c in slots.columns if c not in (key, "__slot")]
    # A key has as many rows as hours in which it did something.
    in_order = F.array_sort(F.collect_list(F.struct("__slot", *functions)))
    per_key = slots.groupBy(key).agg(in_order.alias("__slots"))
    at = dict(slots.dtypes)[functions[0]]
    nowhere = F.struct(*(F.lit(None).cast(at).alias(f"t{j}") for j in range(1, len(steps) + 1)))

    def compose(state: Column, then: Column) -> Column:
        reached = sum((state[f"t{j}"].isNotNull().cast("int") for j in range(1, len(steps) + 1)), F.lit(0))
        out = []
        for j in range(1, len(steps) + 1):
            later = F.lit(None).cast(at)
            for n in range(j):
                later = F.when(reached == n, then[f"r{n}_{j}"]).otherwise(later)
            out.append(F.coalesce(state[f"t{j}"], later).alias(f"t{j}"))
        return F.struct(*out)

    composed = per_key.select(key, F.aggregate("__slots", nowhere, compose).alias("__t"))
    times = (F.col(f"__t.t{j}").alias(f"{name}_time") for j, name in enumerate(names, start=1))
    return composed.select(key, *times).where(F.col(f"{names[0]}_time").isNotNull())


def funnel(
    events: DataFrame,
    steps: Sequence[tuple[str, Collection[str]]] = FUNNEL_STEPS,
    key: str = "user_id",
    ts: str = "event_timestamp",
    kind: str = "event_type",
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """One row per step: keys that reached it, step conversion, drop-off and total conversion."""
    reached = funnel_step_times(events, steps, key, ts, kind, start, end)
    counts = reached.agg(*(F.count(f"{name}_time").alias(name) for name, _ in steps))
    cells = ", ".join(
        f"'{i}_{name}', {i}, `{name}`" for i, (name, _) in enumerate(steps, start=1)
    )
    rows = counts.selectExpr(
        f"stack({len(steps)}, {cells}) AS (stage_name, step_order, users_reached)"
    )
    # One row per step reaches these windows.
    in_order = W.orderBy("step_order")
    users = F.col("users_reached")
    before = F.lag("users_reached").over(in_order)
    top = F.first_value("users_reached").over(in_order)
    return rows.select(
        "stage_name",
        F.col("step_order").cast("bigint").alias("step_order"),
        "users_reached",
        pct(users, before).alias("step_conversion_pct"),
        round_half_up(F.lit(100.0) - ratio_pct(users, before), 2).alias("step_dropoff_pct"),
        pct(users, top).alias("funnel_conversion_pct"),
    ).orderBy("step_order")


def user_activity(
    dim_user: DataFrame,
    events: DataFrame,
    orders: DataFrame,
    as_of: date,
    days: int = 30,
    order_types: Collection[str] | None = ("purchase",),
) -> DataFrame:
    """Engagement and spend per current user since ``as_of - days``.

    Orders are linked to events by id and day. Only events of ``order_types`` can
    carry an order, so only those are shuffled by event; pass None to link all.
    Events are reduced to one row per user before they meet the dimension.
    """
    since = as_of - timedelta(days=days)
    recent = events.where(between_days("event_date", since) & F.col("user_id").isNotNull()).select(
        "user_id", "event_id", "event_type", "event_date", "event_timestamp"
    )
    paid = orders.where(between_days("order_date", since)).select(
        "event_id", F.col("order_date").alias("event_date"), "order_amount"
    )
    if order_types is None:
        linked = recent.join(paid, ["event_id", "event_date"], "left")
    else:
        may_pay = F.coalesce(F.col("event_type").isin(list(order_types)), F.lit(False))
        linked = (
            recent.where(may_pay)
            .join(paid, ["event_id", "event_date"], "left")
            .unionByName(
                recent.where(~may_pay).withColumn(
                    "order_amount", F.lit(None).cast("decimal(10,2)")
                )
            )
        )

    def of_type(name: str) -> Column:
        return F.count_if(F.col("event_type") == name)

    per_user = linked.groupBy("user_id").agg(
        F.count("*").alias("total_events"),
        F.count_distinct(F.col("event_date")).alias("active_days"),
        of_type("post").alias("post_count"),
        of_type("like").alias("like_count"),
        of_type("purchase").alias("purchase_count"),
        F.coalesce(F.sum("order_amount"), F.lit(0)).cast("decimal(20,2)").alias("total_spend"),
        F.max("event_timestamp").alias("last_active_at"),
    )
    current = dim_user.where("is_current").select("user_id", "country", "preferred_platform")
    return current.join(per_user, "user_id")


# Tier label and the highest percent rank it covers; the last tier takes the rest.
TIERS: tuple[tuple[str, float], ...] = (
    ("1_POWER_CREATOR", 0.05),
    ("2_CORE_ENGAGER", 0.20),
    ("3_CASUAL_CONSUMER", 0.60),
)
LAST_TIER = "4_LIGHT_USER"


def tier_of(percent_rank: Column) -> Column:
    """Activity tier of a percent rank."""
    label = F.lit(LAST_TIER)
    for name, upto in reversed(TIERS):
        label = F.when(percent_rank <= upto, F.lit(name)).otherwise(label)
    return label


def segment_users(activity: DataFrame, buckets: int = 10) -> DataFrame:
    """Per user: percent rank and decile by events, and the tier they imply."""
    ranked = rank_descending(
        activity, "total_events", "user_id", buckets, "activity_percentile_rank", "activity_decile"
    )
    return ranked.withColumn("user_tier", tier_of(F.col("activity_percentile_rank")))


def segment_summary(activity: DataFrame) -> DataFrame:
    """Size, averages and revenue share per tier.

    All users with the same number of events share a tier, so users are first
    summed per number of events; no ranking of single users is needed.
    """
    by_events = activity.groupBy("total_events").agg(
        F.count("*").alias("users"),
        *(
            F.sum(c).alias(c)
            for c in ("active_days", "post_count", "like_count", "total_spend")
        ),
    )
    # ``d`` distinct event counts need at least d(d+1)/2 events, so few rows reach this window.
    busier = W.orderBy(F.col("total_events").desc()).rowsBetween(W.unboundedPreceding, -1)
    everyone = W.partitionBy()
    ahead = F.coalesce(F.sum("users").over(busier), F.lit(0))
    rank = percent_rank_of(ahead, F.sum("users").over(everyone))
    tiers = (
        by_events.withColumn("user_tier", tier_of(rank))
        .groupBy("user_tier")
        .agg(
            F.sum("users").alias("total_users"),
            F.sum(F.col("total_events") * F.col("users")).alias("events"),
            *(
                F.sum(c).alias(c)
                for c in ("active_days", "post_count", "like_count", "total_spend")
            ),
        )
    )

    def mean(column: str) -> Column:
        return round_half_up(F.col(column).cast("double") / F.col("total_users"), 1)

    return tiers.select(
        "user_tier",
        "total_users",
        pct(F.col("total_users"), F.sum("total_users").over(everyone)).alias("pct_of_userbase"),
        mean("events").alias("avg_events_per_user"),
        mean("active_days").alias("avg_active_days_30d"),
        mean("post_count").alias("avg_posts"),
        mean("like_count").alias("avg_likes"),
        F.col("total_spend").cast("double").alias("tier_total_revenue"),
        pct(F.col("total_spend"), F.sum("total_spend").over(everyone)).alias(
            "pct_of_total_revenue"
        ),
    ).orderBy("user_tier")

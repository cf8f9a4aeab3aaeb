"""One registered query per operator, each over its whole input tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import json_contains, json_text, product_number, utc_timestamp
from tidemark.functions.days import within_day
from tidemark.operators import quality
from tidemark.operators.activity import active_days
from tidemark.operators.keys import dense_keys
from tidemark.operators.latest import latest_per_key
from tidemark.operators.scd2 import (
    interval_problems,
    new_keys,
    pit_join,
    scd2_history,
    scd2_merge,
)
from tidemark.operators.skew import skewed_join
from tidemark.plans import daily, dims, facts, file_checks, lookups, marts, warehouse
from tidemark.schemas import (
    DEFAULTS,
    EVENT_TYPES,
    FACT_ORDERS,
    MAX_LENGTHS,
    PLATFORMS,
    UUID_PATTERN,
    conform,
)
from tidemark.sources.compaction import compact_lake
from tidemark.sources.events import (
    partition_inventory,
    quarantined,
    read_day,
    read_events,
    read_raw,
    rejected_rows,
    typed_columns,
)
from tidemark.sources.scratch import new_folder
from tidemark.sources.sinks import (
    overwrite_partitions,
    raw_rows,
    write_json_lake,
    write_parquet_lake,
)
from workload.fixtures import (
    AS_OF,
    ORDERS_AS_OF,
    RETENTION_AS_OF,
    client_documents,
    customer_orders,
    dirty_events,
    dirty_lake_rows,
    events,
    strangers,
    user_day_events,
)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

FRESH_AT = datetime(2024, 1, 31, 12, 0, 0)
LAST_DAY = date(2024, 1, 30)
AS_OF_DAYS = (date(2024, 1, 5), date(2024, 1, 17), date(2024, 1, 29))
DRIFT = 0.05


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def query_named(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        _QUERIES[name] = fn
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, counts as 64-bit, so that engines compare alike."""
    cols = []
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if kind == "decimal":
            cols.append(F.col(field.name).cast("double").alias(field.name))
        elif kind in ("integer", "short"):
            cols.append(F.col(field.name).cast("bigint").alias(field.name))
        else:
            cols.append(F.col(field.name))
    return df.select(*cols)


def _ended() -> Column:
    """End of a version, NULL while it is open."""
    return F.when(~F.col("is_current"), F.col("valid_to")).alias("valid_to")


def _newest_day(rows: DataFrame) -> date:
    return rows.agg(F.max("event_date").alias("day")).first().day


def _lake(spark: SparkSession, sf_dir: str) -> str:
    root = new_folder(spark, "lake")
    write_parquet_lake(events(spark, sf_dir), root)
    return root


# --- scans, staging, sinks ---------------------------------------------------


@query
def scan_raw_events(spark, sf_dir):
    return _plain(raw_rows(events(spark, sf_dir)).select(*typed_columns()))


@query
def scan_one_day(spark, sf_dir):
    day = within_day("event_timestamp", LAST_DAY) & (F.col("event_date") == F.lit(LAST_DAY))
    return events(spark, sf_dir).where(day).select(
        "event_id", "user_id", "event_type", "event_timestamp"
    )


@query
def stage_events(spark, sf_dir):
    raw = raw_rows(events(spark, sf_dir)).withColumn("date", F.to_date("event_date"))
    staged = facts.stage_events(raw)
    return _plain(
        staged.groupBy("event_date", "event_type", "platform", "country").agg(
            F.count("*").alias("n"),
            F.sum("amount").alias("amount"),
            F.min("event_timestamp").alias("first_at"),
            F.max("event_timestamp").alias("last_at"),
        )
    )


@query
def conform_schema(spark, sf_dir):
    loose = events(spark, sf_dir).select(
        F.concat(F.lit("ORD_"), F.col("event_id").cast("string")).alias("order_id"),
        "event_id",
        F.col("event_timestamp").alias("order_timestamp"),
        F.col("event_date").alias("order_date"),
        "user_id",
        F.col("amount").cast("double").alias("order_amount"),
        F.when(F.col("event_type") == "like", F.lit("EUR")).alias("currency"),
    )
    whole = conform(loose, FACT_ORDERS, DEFAULTS["fact_orders"])
    return _plain(whole.drop("order_sk", "user_sk", "product_sk", "payment_gateway"))


@query
def parquet_roundtrip(spark, sf_dir):
    return _plain(read_events(spark, _lake(spark, sf_dir), typed=True))


@query
def json_roundtrip(spark, sf_dir):
    root = new_folder(spark, "json-lake")
    # Keys out of order, a number with a final zero, and text that is not JSON.
    text = F.concat(F.lit('{"z": 1.50,'), F.substring("metadata", 2, 1000))
    text = F.when(F.col("event_id") % 7 == 0, F.lit("no: json")).otherwise(text)
    write_json_lake(events(spark, sf_dir).withColumn("metadata", text), root)
    return _plain(read_events(spark, root, fmt="json"))


@query
def scan_untyped_product(spark, sf_dir):
    """The default reader over a lake where the likes' files hold no typed product."""
    root = new_folder(spark, "untyped-lake")
    rows = raw_rows(events(spark, sf_dir)).withColumn("date", F.to_date("event_date"))
    likes = F.col("event_type") == "like"
    untyped = rows.where(likes).withColumn("product_id", F.lit(None).cast("int"))
    for part in (rows.where(~likes), untyped):
        part.write.partitionBy("date").mode("append").parquet(root)
    return _plain(read_events(spark, root))


@query
def lake_one_day(spark, sf_dir):
    raw = read_day(spark, _lake(spark, sf_dir), LAST_DAY, typed=True)
    return _plain(facts.stage_events(raw, LAST_DAY))


@query_named("partition_inventory")
def inventory_of_days(spark, sf_dir):
    """Two Parquet files per day, for the last day a third without rows, and one of JSON."""
    root = new_folder(spark, "mixed-lake")
    rows = raw_rows(events(spark, sf_dir)).withColumn("date", F.to_date("event_date"))
    signups = F.col("event_type") == "signup"
    for part in (rows.where(signups), rows.where(~signups)):
        part.repartition("date").write.partitionBy("date").mode("append").parquet(root)
    none = rows.where(F.lit(False)).drop("date").coalesce(1)
    none.write.mode("append").parquet(f"{root}/date={LAST_DAY}")
    last = events(spark, sf_dir).where(F.col("event_date") == F.lit(LAST_DAY))
    write_json_lake(last.repartition(1), root)
    found = partition_inventory(spark, root)
    return found.select("date", "format", "n_files", (F.col("n_bytes") > 0).alias("has_bytes"), "n_rows")


@query
def idempotent_overwrite(spark, sf_dir):
    path = new_folder(spark, "overwrite")
    rows = events(spark, sf_dir)
    overwrite_partitions(rows, path, "event_date", sort_col="event_timestamp")
    overwrite_partitions(rows, path, "event_date", sort_col="event_timestamp")
    # A rerun of the last day that yields no rows empties that day.
    none = rows.where(F.lit(False))
    overwrite_partitions(none, path, "event_date", [LAST_DAY])
    table = spark.read.parquet(path)
    return _plain(
        table.groupBy("event_date").agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))
    )


# --- filters and scalar functions --------------------------------------------


@query
def filter_purchases(spark, sf_dir):
    rows = facts.purchases(events(spark, sf_dir))
    return _plain(rows.select("event_id", "user_id", "amount", "product_id"))


@query
def intraday_range(spark, sf_dir):
    low, high = (F.lit(f"{LAST_DAY} {h}:00:00").cast("timestamp_ntz") for h in ("09", "17"))
    ts = F.col("event_timestamp")
    rows = events(spark, sf_dir).where((ts >= low) & (ts < high))
    return rows.select("event_id", "user_id", "event_timestamp", "session_id")


@query
def user_type_lookup(spark, sf_dir):
    """Likes of every user who once paid more than most, by a keyed lookup."""
    rows = events(spark, sf_dir)
    buyers = rows.where((F.col("event_type") == "purchase") & (F.col("amount") > F.lit(150)))
    likes = rows.where(F.col("event_type") == "like")
    wanted = buyers.select("user_id").distinct()
    return skewed_join(likes, wanted, "user_id", spread_by=["event_id"]).select(
        "user_id", "event_id", "event_timestamp"
    )


@query
def session_lookup(spark, sf_dir):
    """Size and span of every session."""
    return (
        events(spark, sf_dir)
        .groupBy("session_id", "user_id")
        .agg(
            F.count("*").alias("n"),
            F.min("event_timestamp").alias("first_at"),
            F.max("event_timestamp").alias("last_at"),
        )
    )


def _stored(rows: DataFrame, part: str, sort: str, cluster: tuple, lookup: tuple) -> DataFrame:
    """``rows`` as the fact sink lays them out."""
    spark = rows.sparkSession
    path = new_folder(spark, "facts")
    overwrite_partitions(rows, path, part, sort_col=sort, cluster=cluster, lookup=lookup)
    return spark.read.parquet(path)


def _stored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(
        events(spark, sf_dir), "event_date", "event_timestamp", lookups.EVENT_CLUSTER, lookups.EVENT_LOOKUPS
    )


@query
def lookup_session(spark, sf_dir):
    """The whole session of the newest purchase."""
    stored = _stored_events(spark, sf_dir)
    bought = stored.where(F.col("event_type") == "purchase")
    newest = F.max_by("session_id", F.struct("event_timestamp", "event_id"))
    wanted = bought.agg(newest.alias("session_id")).first().session_id
    return lookups.session_events(stored, wanted).select(
        "session_id", "event_id", "event_type", "event_timestamp"
    )


@query
def lookup_user_type(spark, sf_dir):
    """The likes of the user whose purchase was the largest."""
    stored = _stored_events(spark, sf_dir)
    largest = F.max_by("user_id", F.struct("amount", F.col("event_id")))
    wanted = stored.agg(largest.alias("user_id")).first().user_id
    return lookups.user_events(stored, wanted, "like").select("user_id", "event_id", "event_timestamp")


@query
def lookup_user_orders(spark, sf_dir):
    """The last fortnight's orders of the user version that ordered most often."""
    rows = events(spark, sf_dir)
    orders = facts.snapshot_fact_orders(rows, dims.dim_user_snapshot(rows))
    stored = _stored(
        orders, "order_date", "order_timestamp", lookups.ORDER_CLUSTER, lookups.ORDER_LOOKUPS
    )
    busiest = F.max_by("user_sk", F.struct("n", -F.col("user_sk")))
    wanted = stored.groupBy("user_sk").agg(F.count("*").alias("n")).agg(busiest.alias("sk")).first().sk
    found = lookups.user_orders(stored, wanted, LAST_DAY - timedelta(days=13), LAST_DAY)
    return _plain(found.select("user_sk", "order_id", "order_date", "order_amount"))


@query
def json_filter(spark, sf_dir):
    wanted = json_contains(F.col("metadata"), {"payment_gateway": "stripe"})
    return events(spark, sf_dir).where(wanted).select("event_id", "user_id", "metadata")


@query_named("json_contains")
def nested_containment(spark, sf_dir):
    """Which of five patterns every event's nested document holds."""
    doc = F.col("doc")
    patterns = {
        "by_key": {"client": {"os.name": "ios", "build": 3}},
        "by_items": {"tags": [{"gateway": "stripe"}, "paid"]},
        "by_number": {"cart": {"lines": [{"price": 1.0}]}},
        "by_null": {"client": {"beta": None}, "tags": []},
        "by_depth": {"path": [[1, [2]], ["x"]]},
    }
    held = [json_contains(doc, wanted).alias(name) for name, wanted in patterns.items()]
    return client_documents(spark, sf_dir).select("event_id", *held)


@query
def json_extract(spark, sf_dir):
    doc = F.col("metadata")
    return (
        events(spark, sf_dir)
        .groupBy(
            json_text(doc, "client_version").alias("client_version"),
            json_text(doc, "payment_gateway").alias("payment_gateway"),
        )
        .agg(F.count("*").alias("n"))
    )


@query
def product_sk_parse(spark, sf_dir):
    return events(spark, sf_dir).select(
        "event_id", product_number(F.col("product_id")).cast("bigint").alias("product_sk")
    )


@query
def iso_timestamp_parse(spark, sf_dir):
    rows = events(spark, sf_dir)
    whole = F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return rows.select(
        "event_id",
        utc_timestamp(F.concat(fraction, F.lit("Z"))).alias("exact_at"),
        utc_timestamp(F.concat(whole, F.lit("Z"))).alias("second_at"),
    )


# --- dimensions --------------------------------------------------------------


@query
def dim_date(spark, sf_dir):
    rows = dims.dim_date_of(events(spark, sf_dir))
    return _plain(
        rows.withColumn("partition_label", dims.partition_label(F.col("calendar_date")))
    )


@query
def dim_product(spark, sf_dir):
    sold = dims.catalog_sales(dims.dim_product(spark), events(spark, sf_dir))
    return _plain(sold.drop("product_name"))


@query
def product_lookup(spark, sf_dir):
    joined = facts.product_lookup(events(spark, sf_dir), dims.dim_product(spark))
    return _plain(joined.select("event_id", "product_id", "product_sk"))


@query
def dim_user_snapshot(spark, sf_dir):
    users = dims.dim_user_snapshot(events(spark, sf_dir))
    return users.drop("valid_to")


# --- aggregation and keys ----------------------------------------------------


@query
def latest_per_user(spark, sf_dir):
    wanted = ["user_id", "event_id", "event_timestamp", "country", "platform"]
    return latest_per_key(events(spark, sf_dir).select(*wanted), ["user_id"])


@query_named("active_days")
def active_user_days(spark, sf_dir):
    return active_days(events(spark, sf_dir))


@query
def first_seen(spark, sf_dir):
    return marts.first_seen(events(spark, sf_dir))


@query
def daily_counts(spark, sf_dir):
    return events(spark, sf_dir).groupBy("event_date").agg(F.count("*").alias("n"))


@query
def dau(spark, sf_dir):
    return marts.dau(events(spark, sf_dir))


@query
def surrogate_keys(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "event_timestamp", "user_id")
    return dense_keys(rows, ["event_timestamp", "event_id"], "event_sk")


# --- marts -------------------------------------------------------------------


@query
def mau_trailing(spark, sf_dir):
    return marts.mau_trailing(events(spark, sf_dir), AS_OF)


@query
def dau_mau(spark, sf_dir):
    return marts.dau_mau(events(spark, sf_dir), AS_OF)


@query
def retention_counts(spark, sf_dir):
    return marts.retention_counts(customer_orders(spark, sf_dir))


@query
def retention_cohorts(spark, sf_dir):
    return marts.retention(events(spark, sf_dir), RETENTION_AS_OF)


@query
def retention_cohorts_sparse(spark, sf_dir):
    return marts.retention(customer_orders(spark, sf_dir), ORDERS_AS_OF)


@query
def funnel_step_times(spark, sf_dir):
    return marts.funnel_step_times(user_day_events(spark, sf_dir))


@query
def conversion_funnel(spark, sf_dir):
    return marts.funnel(user_day_events(spark, sf_dir))


def _activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir)
    users = scd2_history(rows, surrogate=None)
    orders = facts.purchases(rows).select(
        "event_id",
        F.col("event_date").alias("order_date"),
        F.col("amount").alias("order_amount"),
    )
    return marts.user_activity(users, rows, orders, AS_OF)


@query
def user_activity(spark, sf_dir):
    return _plain(_activity(spark, sf_dir))


@query
def user_deciles(spark, sf_dir):
    ranked = marts.segment_users(_activity(spark, sf_dir))
    return ranked.select(
        "user_id", "total_events", "activity_percentile_rank", "activity_decile", "user_tier"
    )


@query
def user_segmentation(spark, sf_dir):
    return marts.segment_summary(_activity(spark, sf_dir))


# --- user history and facts --------------------------------------------------

_VERSION = ("user_id", "country", "preferred_platform", "user_tier", "valid_from")


@query_named("scd2_history")
def history_of_users(spark, sf_dir):
    history = scd2_history(events(spark, sf_dir))
    return history.select("user_sk", *_VERSION, _ended(), "is_current")


@query
def scd2_first_event_start(spark, sf_dir):
    history = scd2_history(events(spark, sf_dir), new_key_start="first", surrogate=None)
    return history.select(*_VERSION, _ended(), "is_current")


@query
def scd2_closed(spark, sf_dir):
    history = scd2_history(events(spark, sf_dir), surrogate=None)
    return history.where(~F.col("is_current")).select(*_VERSION, "valid_to")


@query
def current_users(spark, sf_dir):
    history = scd2_history(events(spark, sf_dir), surrogate=None)
    return history.where("is_current").select(*_VERSION)


@query
def scd2_merge_batch(spark, sf_dir):
    """All days but the last as history, then the last one merged as a batch."""
    rows = events(spark, sf_dir)
    last = _newest_day(rows)
    before = scd2_history(rows.where(F.col("event_date") < F.lit(last)))
    merged = scd2_merge(before, rows.where(F.col("event_date") == F.lit(last)))
    return merged.select("user_sk", *_VERSION, _ended(), "is_current")


@query
def new_users_anti(spark, sf_dir):
    """Users of a batch, some of them strangers, without an open version."""
    known = scd2_history(events(spark, sf_dir), surrogate=None)
    return new_keys(known.where("is_current"), strangers(spark, sf_dir))


@query_named("pit_join")
def point_in_time_join(spark, sf_dir):
    rows = events(spark, sf_dir)
    joined = pit_join(rows, scd2_history(rows), take=("user_sk", "preferred_platform"))
    return joined.select("event_id", "user_id", "event_timestamp", "user_sk", "preferred_platform")


@query
def load_fact_events(spark, sf_dir):
    rows = events(spark, sf_dir)
    return facts.load_fact_events(rows, scd2_history(rows)).drop("event_sk")


@query
def load_fact_orders(spark, sf_dir):
    rows = events(spark, sf_dir)
    orders = facts.load_fact_orders(rows, scd2_history(rows), dims.dim_product(spark))
    return _plain(orders.drop("order_sk"))


@query
def fact_keys(spark, sf_dir):
    """Per day: facts, distinct keys, and facts that get the same key when loaded in another order."""
    rows = events(spark, sf_dir)
    users = scd2_history(rows)
    once = facts.load_fact_events(rows, users).select("event_date", "event_id", "event_sk")
    again = facts.load_fact_events(rows.repartition("session_id"), users)
    both = once.join(again.select("event_id", F.col("event_sk").alias("again")), "event_id")
    return both.groupBy("event_date").agg(
        F.count("*").alias("n"),
        F.count_distinct("event_sk").alias("n_keys"),
        F.count_if(F.col("event_sk") == F.col("again")).alias("n_same"),
    )


@query
def completed_orders(spark, sf_dir):
    """Orders per user and day among those completed; every tenth is taken as refunded."""
    rows = events(spark, sf_dir)
    orders = facts.load_fact_orders(rows, scd2_history(rows), dims.dim_product(spark), keyed=False)
    refunded = F.when(F.col("event_id") % 10 == 0, F.lit("refunded"))
    orders = orders.withColumn("order_status", F.coalesce(refunded, "order_status"))
    return _plain(
        orders.where(F.col("order_status") == "completed")
        .groupBy("user_sk", "order_date")
        .agg(F.count("*").alias("n"), F.sum("order_amount").alias("amount"))
    )


@query
def facts_snapshot_join(spark, sf_dir):
    rows = events(spark, sf_dir)
    return facts.snapshot_fact_events(rows, dims.dim_user_snapshot(rows))


@query
def orders_snapshot(spark, sf_dir):
    rows = events(spark, sf_dir)
    return _plain(facts.snapshot_fact_orders(rows, dims.dim_user_snapshot(rows)))


@query
def daily_load(spark, sf_dir):
    """Rebuild every day but the last from the lake, load the last one, and rerun it."""
    lake, target = _lake(spark, sf_dir), new_folder(spark, "warehouse")
    last = _newest_day(events(spark, sf_dir))
    daily.rebuild(spark, lake, target, upto=last - timedelta(days=1), typed=True)
    for _ in range(2):
        daily.run_daily(spark, lake, target, last, typed=True)
    return _loaded(spark, target)


@query
def daily_load_after_rebuild(spark, sf_dir):
    """Rebuild to the newest day, rerun it, come with a late day, rerun the newest day again."""
    lake, target = _lake(spark, sf_dir), new_folder(spark, "warehouse")
    last = _newest_day(events(spark, sf_dir))
    daily.rebuild(spark, lake, target, typed=True)
    daily.run_daily(spark, lake, target, last, typed=True)
    late = last - timedelta(days=3)
    daily.run_daily(spark, lake, target, late, typed=True, rebuild_if_older=True)
    daily.run_daily(spark, lake, target, last, typed=True)
    return _loaded(spark, target)


@query
def dim_user_as_of(spark, sf_dir):
    """What the dimension was after three earlier days, read after a rebuild to the newest."""
    lake, target = _lake(spark, sf_dir), new_folder(spark, "warehouse")
    daily.rebuild(spark, lake, target, typed=True)
    parts = []
    for day in AS_OF_DAYS:
        users = daily.read_dim_user(spark, target, as_of=day)
        parts.append(users.select(F.lit(day).alias("as_of"), *_VERSION, _ended(), "is_current"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _incremental(spark: SparkSession, sf_dir: str, runs: int) -> str:
    """A warehouse rebuilt to the day before the newest, which is then loaded so many times."""
    lake, target = _lake(spark, sf_dir), new_folder(spark, "warehouse")
    last = _newest_day(events(spark, sf_dir))
    daily.rebuild(spark, lake, target, upto=last - timedelta(days=1), typed=True)
    for _ in range(runs):
        daily.run_daily(spark, lake, target, last, typed=True)
    return target


@query
def dau_mau_kept_words(spark, sf_dir):
    """Stickiness from the activity words that the loads keep."""
    words = daily.read_activity_words(spark, _incremental(spark, sf_dir, 2))
    return marts.dau_mau_of_words(words, AS_OF)


@query
def retention_kept_words(spark, sf_dir):
    """Retention from the activity words that the loads keep."""
    words = daily.read_activity_words(spark, _incremental(spark, sf_dir, 1))
    return marts.retention_of_words(words, RETENTION_AS_OF)


@query
def empty_day_rerun(spark, sf_dir):
    """Load to the newest day, take its rows out of the lake but not its folder, and rerun it."""
    lake, target = _lake(spark, sf_dir), new_folder(spark, "warehouse")
    rows = events(spark, sf_dir)
    last = _newest_day(rows)
    daily.rebuild(spark, lake, target, typed=True)
    held = read_day(spark, lake, last, typed=True).where(F.lit(False)).drop("date")
    held.coalesce(1).write.mode("overwrite").parquet(f"{lake}/date={last}")
    daily.run_daily(spark, lake, target, last, typed=True)
    daily.run_daily(spark, lake, target, last + timedelta(days=1), typed=True)
    return _loaded(spark, target)


@query
def activity_of_loaded_tables(spark, sf_dir):
    """User activity over what the loader wrote, instead of over staged events."""
    lake, target = _lake(spark, sf_dir), new_folder(spark, "warehouse")
    daily.rebuild(spark, lake, target, typed=True)
    found = marts.user_activity(
        daily.read_dim_user(spark, target),
        daily.read_fact_events(spark, target),
        daily.read_fact_orders(spark, target),
        AS_OF,
    )
    return _plain(found)


def _loaded(spark: SparkSession, target: str) -> DataFrame:
    """Counts and keys of every table of a warehouse, per day."""
    zero = F.lit(0).cast("double")
    event_rows = daily.read_fact_events(spark, target).groupBy("event_date").agg(
        F.count("*").alias("n"),
        F.sum("user_sk").alias("sk_sum"),
        F.count_distinct("event_sk").alias("n_keys"),
    )
    order_rows = daily.read_fact_orders(spark, target).groupBy("order_date").agg(
        F.count("*").alias("n"),
        F.sum("user_sk").alias("sk_sum"),
        F.count_distinct("order_sk").alias("n_keys"),
        F.sum("order_amount").cast("double").alias("amount"),
    )
    users = daily.read_dim_user(spark, target)
    user_rows = users.groupBy(F.to_date("valid_from").alias("day")).agg(
        F.count("*").alias("n"),
        F.sum("user_sk").alias("sk_sum"),
        F.count_distinct("user_sk").alias("n_keys"),
    )
    parts = [
        ("fact_events", event_rows.withColumnRenamed("event_date", "day").withColumn("amount", zero)),
        ("fact_orders", order_rows.withColumnRenamed("order_date", "day")),
        ("dim_user", user_rows.withColumn("amount", zero)),
    ]
    out = [
        df.select(F.lit(name).alias("loaded_table"), "day", "n", "sk_sum", "n_keys", "amount")
        for name, df in parts
    ]
    return out[0].unionByName(out[1]).unionByName(out[2])


# --- data quality ------------------------------------------------------------


@query
def dq_not_null(spark, sf_dir):
    columns = ["event_id", "user_id", "event_type", "event_timestamp", "event_date", "platform"]
    return quality.not_null(dirty_events(spark, sf_dir), columns)


@query
def dq_unique(spark, sf_dir):
    return quality.duplicate_keys(dirty_events(spark, sf_dir), ["event_date", "event_id"])


@query
def dq_unique_null_as_value(spark, sf_dir):
    return quality.duplicate_keys(dirty_events(spark, sf_dir), ["user_id"], nulls="value")


@query
def dq_duplicates(spark, sf_dir):
    rows = dirty_events(spark, sf_dir)
    by_event = quality.duplicate_count(rows, "event_id").select(
        F.lit("event_id").alias("key"), "duplicates"
    )
    by_user = quality.duplicate_count(rows, "user_id").select(
        F.lit("user_id").alias("key"), "duplicates"
    )
    return by_event.unionByName(by_user)


@query
def dq_accepted_values(spark, sf_dir):
    rows = dirty_events(spark, sf_dir)
    types = quality.unexpected_values(rows, "event_type", EVENT_TYPES)
    platforms = quality.unexpected_values(rows, "platform", PLATFORMS)
    return types.select(F.lit("event_type").alias("field"), "value", "n").unionByName(
        platforms.select(F.lit("platform").alias("field"), "value", "n")
    )


@query
def dq_relationships(spark, sf_dir):
    """Facts, some of them of strangers, whose user has no open version."""
    known = scd2_history(events(spark, sf_dir), surrogate=None)
    return quality.orphans(strangers(spark, sf_dir), known.where("is_current"), "user_id")


@query
def dq_range(spark, sf_dir):
    bad = quality.violations(dirty_events(spark, sf_dir), F.col("amount") >= 0)
    return _plain(bad.select("event_id", "event_date", "amount"))


@query
def dq_freshness(spark, sf_dir):
    return quality.freshness(events(spark, sf_dir), FRESH_AT)


@query
def row_count_drift(spark, sf_dir):
    return quality.row_count_drift(events(spark, sf_dir), threshold=DRIFT)


@query
def dq_suite(spark, sf_dir):
    return quality.event_suite(dirty_events(spark, sf_dir))


@query
def dq_rejected_rows(spark, sf_dir):
    """Why raw rows of a dirty lake cannot be staged, and how many."""
    return rejected_rows(dirty_lake_rows(spark, sf_dir))


@query
def rejected_records(spark, sf_dir):
    """Every raw JSON row that staging cannot hold, some of them no JSON, with its reasons."""
    root = new_folder(spark, "json-lake")
    rows = events(spark, sf_dir)
    n = F.col("event_id")
    kind = F.when(n % 89 != 0, F.col("event_type"))
    amount = F.when(n % 83 == 0, F.lit(250_000_000.0)).otherwise(F.col("amount").cast("double"))
    write_json_lake(rows.withColumns({"event_type": kind, "amount": amount}), root)
    cut_off = F.concat(F.lit('{"event_id":"'), n.cast("string"), F.lit('","user_id":'))
    broken = rows.where(n % 97 == 0).select(cut_off.alias("value"), F.col("event_date").alias("date"))
    broken.write.partitionBy("date").mode("append").text(root)
    kept = quarantined(read_raw(spark, root, fmt="json", source=True))
    record = F.coalesce(F.get_json_object("record", "$.event_id"), "record")
    record = F.when(F.array_contains("reasons", "corrupt_line"), F.col("record")).otherwise(record)
    reasons = F.concat_ws(",", F.array_sort("reasons"))
    return kept.select("date", reasons.alias("reasons"), record.alias("record"))


def _stored_dirty(spark: SparkSession, sf_dir: str) -> str:
    path = new_folder(spark, "table")
    dirty_events(spark, sf_dir).repartition(8).write.parquet(path)
    return path


@query_named("file_not_null")
def not_null_by_footers(spark, sf_dir):
    columns = ["event_id", "user_id", "event_type", "event_timestamp"]
    return file_checks.file_not_null(spark, _stored_dirty(spark, sf_dir), columns)


@query_named("file_freshness")
def freshness_by_footers(spark, sf_dir):
    return file_checks.file_freshness(spark, _stored_dirty(spark, sf_dir), FRESH_AT)


@query
def compacted_lake(spark, sf_dir):
    """Four flushes a day merged into one file; the days as they are read afterwards."""
    root = new_folder(spark, "flushes")
    rows = events(spark, sf_dir)
    for turn in range(4):
        part = rows.where(F.pmod(F.col("event_id"), F.lit(4)) == turn)
        write_parquet_lake(part.repartition(1, "event_date"), root)
    merged = compact_lake(spark, root)
    counts = spark.createDataFrame(
        [(day, *n) for day, n in merged.items()], "date date, n_before bigint, n_after bigint"
    )
    per_day = read_raw(spark, root, typed=True).groupBy("date").agg(
        F.count("*").alias("n"), F.sum(F.col("amount").cast("decimal(10,2)")).cast("double").alias("amount")
    )
    return counts.join(per_day, "date")


@query
def dq_gate(spark, sf_dir):
    rules = {
        "amount": "amount",
        "categories": {"event_type": EVENT_TYPES, "platform": PLATFORMS},
    }
    return quality.gate_report(dirty_events(spark, sf_dir), **rules)


@query
def dq_scd2_intervals(spark, sf_dir):
    return interval_problems(scd2_history(events(spark, sf_dir), surrogate=None))


@query
def dq_text_limits(spark, sf_dir):
    """Purchases keep their number as id, which is no UUID; two event types exceed five letters."""
    digest = F.md5(F.col("event_id").cast("string"))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    uuid = F.concat_ws("-", *(F.substring(digest, start, size) for start, size in cuts))
    is_purchase = F.col("event_type") == "purchase"
    rows = events(spark, sf_dir).withColumn(
        "event_id", F.when(is_purchase, F.col("event_id").cast("string")).otherwise(uuid)
    )
    limits = {**MAX_LENGTHS, "event_type": 5}
    return quality.text_limits(rows, limits, {"event_id": UUID_PATTERN})


@query
def dq_declared(spark, sf_dir):
    """All declared tests over loaded tables; some facts get a key that no user has."""
    lake, target = _lake(spark, sf_dir), new_folder(spark, "warehouse")
    daily.rebuild(spark, lake, target, typed=True)
    lost = F.col("event_id").cast("bigint") % 97 == 0
    user = F.when(lost, -F.col("user_sk")).otherwise(F.col("user_sk"))
    return quality.declared_checks(
        {
            "dim_user": daily.read_dim_user(spark, target),
            "fact_events": daily.read_fact_events(spark, target).withColumn("user_sk", user),
            "fact_orders": daily.read_fact_orders(spark, target),
            "stg_events": dirty_events(spark, sf_dir),
        }
    )


@query
def snapshot_views(spark, sf_dir):
    """SQL over the views of a warehouse taken straight from the lake."""
    tables = warehouse.snapshot_tables(spark, _lake(spark, sf_dir), typed=True)
    warehouse.register_views(tables, "snap_")
    return _plain(
        spark.sql(
            """
            SELECT d.calendar_date, d.day_name, u.preferred_platform,
                   COUNT(*) AS events, COUNT(o.order_id) AS orders,
                   SUM(o.order_amount) AS revenue, MAX(e.event_sk) AS top_sk
            FROM snap_fact_events e
            JOIN snap_dim_user u ON e.user_sk = u.user_sk
            JOIN snap_dim_date d ON d.calendar_date = e.event_date
            LEFT JOIN snap_fact_orders o
              ON o.event_id = e.event_id AND o.order_date = e.event_date
            GROUP BY d.calendar_date, d.day_name, u.preferred_platform
            """
        )
    )

"""The daily load: check, stage, gate, merge users, load facts, publish all of it at once.

Tables of a warehouse folder, by the partitions that a load replaces:

* ``dim_user_versions`` by ``batch_date``  the user versions that a batch opened
* ``dim_user_open`` by ``batch_date``      all open versions after a batch, every few batches
* ``fact_events`` by ``event_date`` and ``fact_orders`` by ``order_date``
* ``event_ids`` by ``event_date``          the ids of staged events, by which a day finds those
                                           that another day has already
* ``activity_words`` by ``word``           users' active days as bits, 60 days a word
* ``rejected`` by ``date``                 raw rows that staging could not hold, with reasons

A version is stored once, by the batch that opened it; it ends where its user's next
one starts. So a batch writes only what changed, a rerun replaces exactly what it wrote,
and the state before any day is what earlier batches opened. The newest copy of the open
versions spares a batch the ones before it. Tables change together when a load publishes, see
:mod:`tidemark.sources.published`; a load that fails leaves them as they were.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.days import as_date
from tidemark.operators.activity import day_words, merge_day, word_of
from tidemark.operators.latest import latest_per_key
from tidemark.operators.quality import STAGING_RULES, DataQualityError, gate
from tidemark.operators.scd2 import opened_versions, scd2_history
from tidemark.operators.skew import hot_keys
from tidemark.plans import lookups
from tidemark.plans.dims import dim_product
from tidemark.plans.facts import load_fact_events, load_fact_orders, purchases, stage_events
from tidemark.schemas import DIM_USER, FACT_EVENTS, FACT_ORDERS, open_end
from tidemark.sources.events import (
    PARTITION,
    day_exists,
    quarantined,
    read_day,
    read_raw,
    rejects,
    typed_columns,
)
from tidemark.sources.published import Publication, State, read_state, read_table
from tidemark.sources.scratch import pin, releasing

BATCH = "batch_date"
SNAPSHOT_EVERY = 32  # batches
_DIM = [f for f in DIM_USER.fields if f.name != "signup_channel"]
_VERSION = T.StructType([f for f in _DIM if f.name not in ("valid_to", "is_current")])
_DIM_COLUMNS = [f.name for f in _DIM]
_IDS = T.StructType([T.StructField("id_hash", T.LongType()), T.StructField("event_id", T.StringType())])
_WORDS = T.StructType([T.StructField("user_id", T.StringType()), T.StructField("bits", T.LongType())])
_REJECTED = T.StructType(
    [
        T.StructField("reasons", T.ArrayType(T.StringType())),
        T.StructField("file", T.StringType()),
        T.StructField("record", T.StringType()),
    ]
)
# Schema and partition column of every table.
_TABLES = {
    "dim_user_versions": (_VERSION, T.StructField(BATCH, T.DateType())),
    "dim_user_open": (_VERSION, T.StructField(BATCH, T.DateType())),
    "fact_events": (FACT_EVENTS, T.StructField("event_date", T.DateType())),
    "fact_orders": (FACT_ORDERS, T.StructField("order_date", T.DateType())),
    "event_ids": (_IDS, T.StructField("event_date", T.DateType())),
    "activity_words": (_WORDS, T.StructField("word", T.IntegerType())),
    "rejected": (_REJECTED, T.StructField(PARTITION, T.DateType())),
}


def _table(spark: SparkSession, warehouse: str, name: str, state: State | None = None) -> DataFrame:
    """A warehouse table, empty when it was never written."""
    return read_table(spark, warehouse, name, *_TABLES[name], state)


def _days(state: State, name: str) -> list[date]:
    return [date.fromisoformat(value) for value in state.partitions(name)]


def _as_intervals(versions: DataFrame) -> DataFrame:
    """Versions with their ends: each one lasts until its user's next one starts."""
    following = F.lead("valid_from").over(W.partitionBy("user_id").orderBy("valid_from"))
    ended = versions.withColumns(
        {"valid_to": F.coalesce(following, open_end()), "is_current": following.isNull()}
    )
    return ended.select(*_DIM_COLUMNS)


def read_dim_user(
    spark: SparkSession,
    warehouse: str,
    as_of: date | str | None = None,
    state: State | None = None,
) -> DataFrame:
    """All versions, or those known after the batch of ``as_of``.

    Pass one ``state`` to several readers to see them as of the same load.
    """
    versions = _table(spark, warehouse, "dim_user_versions", state)
    if as_of is not None:
        versions = versions.where(F.col(BATCH) <= F.lit(as_date(as_of)))
    return _as_intervals(versions)


def read_fact_events(spark: SparkSession, warehouse: str, state: State | None = None) -> DataFrame:
    return _table(spark, warehouse, "fact_events", state)


def read_fact_orders(spark: SparkSession, warehouse: str, state: State | None = None) -> DataFrame:
    return _table(spark, warehouse, "fact_orders", state)


def read_activity_words(spark: SparkSession, warehouse: str, state: State | None = None) -> DataFrame:
    """``user_id, bits, word``: the days on which users have facts, for the marts of words."""
    return _table(spark, warehouse, "activity_words", state)


def read_rejected(spark: SparkSession, warehouse: str) -> DataFrame:
    """Raw rows that the newest load of their day could not stage: reasons, file, record, day."""
    return _table(spark, warehouse, "rejected")


def open_before(
    spark: SparkSession, warehouse: str, day: date, state: State | None = None
) -> DataFrame:
    """The version that was open before ``day``, per user: one row each."""
    state = read_state(spark, warehouse) if state is None else state
    copies = [d for d in _days(state, "dim_user_open") if d < day]
    versions = _table(spark, warehouse, "dim_user_versions", state).where(F.col(BATCH) < F.lit(day))
    if copies:
        newest = F.lit(max(copies))
        copy = _table(spark, warehouse, "dim_user_open", state).where(F.col(BATCH) == newest)
        versions = versions.where(F.col(BATCH) > newest).unionByName(copy)
    return latest_per_key(versions.drop(BATCH), ["user_id"], "valid_from", "user_sk")


def _write_facts(
    out: Publication, staged: DataFrame, versions: DataFrame, day: date | None
) -> None:
    """Stage both fact tables: one day of them, or the whole tables anew."""
    # Both tables join the same users; they are looked through once.
    hot = hot_keys(staged, "user_id")
    hot_products = hot_keys(purchases(staged), "product_id")
    only = None if day is None else [day]
    out.write(
        load_fact_events(staged, versions, hot=hot),
        "fact_events",
        "event_date",
        "event_timestamp",
        only,
        lookups.EVENT_CLUSTER,
        lookups.EVENT_LOOKUPS,
    )
    products = dim_product(staged.sparkSession)
    out.write(
        load_fact_orders(staged, versions, products, hot=hot, hot_products=hot_products),
        "fact_orders",
        "order_date",
        "order_timestamp",
        only,
        lookups.ORDER_CLUSTER,
        lookups.ORDER_LOOKUPS,
    )


def _ids_of(staged: DataFrame) -> DataFrame:
    return staged.select(F.xxhash64("event_id").alias("id_hash"), "event_id", "event_date")


def _write_ids(out: Publication, staged: DataFrame, day: date | None) -> None:
    only = None if day is None else [day]
    ids = _ids_of(staged)
    out.write(ids, "event_ids", "event_date", "id_hash", only, ["id_hash"], ["id_hash"])


def ids_of_other_days(spark: SparkSession, warehouse: str, staged: DataFrame, day: date) -> int:
    """How many staged rows have the id of an event that another day holds.

    Hashes, eight bytes a row, are compared first, and ids only for the days that hold one of
    the same hash. Spark picks the join by the size of the batch's hashes.
    """
    others = _table(spark, warehouse, "event_ids").where(F.col("event_date") != F.lit(day))
    own = pin(_ids_of(staged).drop("event_date"), "ids")
    near = others.select("id_hash", "event_date").join(own.select("id_hash"), "id_hash", "left_semi")
    days = [r.event_date for r in near.select("event_date").distinct().collect()]
    if not days:
        return 0
    same = others.where(F.col("event_date").isin(days)).select("id_hash", "event_id").distinct()
    return own.join(same, ["id_hash", "event_id"], "left_semi").count()


def _write_words(out: Publication, day: date | None) -> None:
    """Keep the active days of the facts that ``out`` has staged."""
    staged = read_fact_events(out.spark, out.root, out.state)
    if day is None:
        words = day_words(staged.where(F.col("user_id").isNotNull()), "user_id", "event_date")
        out.write(words.select("user_id", "bits", "word"), "activity_words", "word", "user_id")
        return
    word = word_of(day)
    held = _table(out.spark, out.root, "activity_words", out.before)
    kept = held.where(F.col("word") == F.lit(word)).select("user_id", "bits")
    active = staged.where(F.col("event_date") == F.lit(day)).select("user_id").distinct()
    merged = merge_day(kept, active, day).withColumn("word", F.lit(word))
    out.write(merged, "activity_words", "word", "user_id", [word])


def _gated(raw: DataFrame, label: str, key: tuple[str, ...]) -> DataFrame:
    """Staged rows, once no raw row is without a value that its column needs or can hold."""
    bad = {f"bad_{name}": condition.alias(f"bad_{name}") for name, condition in rejects(raw).items()}
    checked = raw.select(*typed_columns(), *bad.values())
    extra = {name.removeprefix("bad_"): F.col(name) for name in bad}
    gate(checked, label, key=key, extra=extra, **STAGING_RULES)
    return stage_events(raw)


def _keep_rejected(spark: SparkSession, warehouse: str, raw: DataFrame, days: list[date] | None) -> None:
    """Publish the rows of ``raw`` that staging cannot hold, whether or not the load goes on."""
    with Publication(spark, warehouse) as out:
        out.write(quarantined(raw), "rejected", PARTITION, "file", days)
        out.publish()


def run_daily(
    spark: SparkSession,
    lake: str,
    warehouse: str,
    day: date | str,
    fmt: str = "parquet",
    typed: bool = False,
    rebuild_if_older: bool = False,
    set_aside: bool = False,
) -> str:
    """Load one day; returns ``loaded``, ``rebuilt`` or ``missing``.

    ``missing`` means that the lake has no folder for the day, and nothing changes; a
    folder without rows empties the day. The batch is gated before anything is published,
    also against the ids of all other days. Rows that staging cannot hold stop it and are then
    found in :func:`read_rejected`; with ``set_aside`` they go there and the others are loaded.
    A day older than the newest merged one is refused, since its versions would overlap
    later ones; with ``rebuild_if_older`` the warehouse is derived anew from the lake.
    """
    ds = as_date(day)
    if not day_exists(spark, lake, ds, fmt):
        return "missing"
    with releasing(spark):
        state = read_state(spark, warehouse)
        newest = max([*_days(state, "dim_user_versions"), *_days(state, "fact_events")], default=None)
        if newest is not None and newest > ds:
            if not rebuild_if_older:
                raise ValueError(f"day {ds} is older than the newest batch {newest}")
            rebuild(spark, lake, warehouse, newest, fmt, typed)
            return "rebuilt"
        raw = read_day(spark, lake, ds, fmt, typed, source=True)
        if set_aside:
            _keep_rejected(spark, warehouse, raw, [ds])
            raw = raw.where(~_any(rejects(raw)))
        try:
            staged = _gated(raw, f"day {ds}", ("event_date", "event_id"))
        except DataQualityError:
            if not set_aside:
                _keep_rejected(spark, warehouse, raw, [ds])
            raise
        if repeated := ids_of_other_days(spark, warehouse, staged, ds):
            raise DataQualityError(f"day {ds}: event_id_of_other_day={repeated}")
        with Publication(spark, warehouse) as out:
            if not set_aside:
                out.drop("rejected", [ds])
            _load_day(out, staged, ds)
            out.publish()
    return "loaded"


def _any(conditions: dict[str, Column]) -> Column:
    found = F.lit(False)
    for condition in conditions.values():
        found = found | F.coalesce(condition, F.lit(False))
    return found


def _load_day(out: Publication, staged: DataFrame, ds: date) -> None:
    spark, warehouse = out.spark, out.root
    before = open_before(spark, warehouse, ds, out.before)
    # A user's newest version has the highest key, so the top key is an open one.
    top = before.agg(F.max("user_sk")).first()[0] or 0
    opened = opened_versions(before, staged, top + 1)
    stamp = F.lit(ds).alias(BATCH)
    out.write(opened.select(*_VERSION.names, stamp), "dim_user_versions", BATCH, "user_id", [ds])

    mine = _table(spark, warehouse, "dim_user_versions", out.state).where(F.col(BATCH) == F.lit(ds))
    both = before.select(*_VERSION.names).unionByName(mine.select(*_VERSION.names))
    _write_facts(out, staged, _as_intervals(both), ds)
    _write_ids(out, staged, ds)
    _write_words(out, ds)
    _copy_open(out, ds)


def _copy_open(out: Publication, ds: date) -> None:
    """Stage the open versions after ``ds`` once enough batches follow the last copy."""
    out.drop("dim_user_open", [ds])
    last = max((d for d in _days(out.state, "dim_user_open") if d < ds), default=date.min)
    batches = [d for d in _days(out.before, "dim_user_versions") if last < d < ds]
    if len(batches) + 1 < SNAPSHOT_EVERY:
        return
    following = date.fromordinal(ds.toordinal() + 1)
    rows = open_before(out.spark, out.root, following, out.state)
    rows = rows.select(*_VERSION.names, F.lit(ds).alias(BATCH))
    out.write(rows, "dim_user_open", BATCH, "user_id", [ds])


def rebuild(
    spark: SparkSession,
    lake: str,
    warehouse: str,
    upto: date | str | None = None,
    fmt: str = "parquet",
    typed: bool = False,
) -> None:
    """Derive the whole warehouse from the lake in one pass, up to a day.

    All tables are replaced: what they hold of later days, or of days that the lake has
    lost, is gone afterwards. An id must not occur twice on any days.
    """
    raw = read_raw(spark, lake, fmt, typed=typed, source=True)
    if upto is not None:
        raw = raw.where(F.col(PARTITION) <= F.lit(as_date(upto)))
    with releasing(spark):
        try:
            staged = _gated(raw, "rebuild", ("event_id",))
        except DataQualityError:
            _keep_rejected(spark, warehouse, raw, None)
            raise
        with Publication(spark, warehouse) as out:
            out.drop("rejected")
            out.drop("dim_user_open")
            history = scd2_history(staged, batch_as=BATCH)
            out.write(history.select(*_VERSION.names, BATCH), "dim_user_versions", BATCH, "user_id")
            _write_facts(out, staged, read_dim_user(spark, warehouse, state=out.state), None)
            _write_ids(out, staged, None)
            _write_words(out, None)
            out.publish()

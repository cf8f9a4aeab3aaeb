"""Literal lookups: right rows, and few row groups read."""

import pytest
from pyspark.sql import functions as F

from tidemark.plans import lookups
from tidemark.sources.sinks import lookup_options, overwrite_partitions, replace_table

ROWS = 20_000


@pytest.fixture
def facts(spark):
    """Two days of 400 users with two sessions each; one user holds a third of the rows."""
    n = F.col("id")
    user = F.when(n % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("U"), (n * 7919 % 400).cast("string")))
    at = F.timestamp_add("SECOND", n % 86_400, F.lit("2024-01-01").cast("timestamp_ntz"))
    return spark.range(ROWS).select(
        n.cast("string").alias("event_id"),
        user.alias("user_id"),
        F.xxhash64(user).alias("user_sk"),
        F.md5(F.concat(user, (n % 2).cast("string"))).alias("session_id"),
        F.element_at(F.array(*map(F.lit, ("like", "login", "post"))), (n % 3 + 1).cast("int")).alias("event_type"),
        at.alias("event_timestamp"),
        F.date_add(F.lit("2024-01-01").cast("date"), (n % 2).cast("int")).alias("event_date"),
    )


@pytest.fixture
def stored(spark, folder, facts):
    """The facts in files of some hundred rows, as a large day has many files."""
    small = {
        "spark.sql.shuffle.partitions": "40",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    }
    before = {name: spark.conf.get(name) for name in small}
    for name, value in small.items():
        spark.conf.set(name, value)
    path = folder("facts")
    overwrite_partitions(
        facts.withColumn("order_date", F.col("event_date")),
        path,
        "event_date",
        sort_col="event_timestamp",
        cluster=lookups.EVENT_CLUSTER,
        lookup=(*lookups.EVENT_LOOKUPS, "user_sk"),
    )
    for name, value in before.items():
        spark.conf.set(name, value)
    return spark.read.parquet(path)


def rows_read(spark, df):
    """The result and how many rows the scan gave, which are those of the row groups read."""
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        fresh = df.select("*")
        execution = fresh._jdf.queryExecution()
        found = len(execution.executedPlan().executeCollect())
        scan = execution.executedPlan().collectLeaves().apply(0)
        return found, scan.metrics().apply("numOutputRows").value()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_a_session_is_read_from_few_row_groups(spark, facts, stored):
    wanted = facts.where("user_id = 'U7'").first().session_id
    found, read = rows_read(spark, lookups.session_events(stored, wanted))
    assert found == facts.where(F.col("session_id") == wanted).count() > 0
    assert read < ROWS / 10
    assert rows_read(spark, lookups.session_events(stored, "no such session"))[1] == 0


def test_a_user_and_type(spark, facts, stored):
    found, read = rows_read(spark, lookups.user_events(stored, "U9", "post"))
    assert found == facts.where("user_id = 'U9' AND event_type = 'post'").count() > 0
    assert read < ROWS / 5
    days = lookups.user_events(stored, "U9", days=["2024-01-02"])
    assert rows_read(spark, days)[0] == facts.where("user_id = 'U9' AND event_date = '2024-01-02'").count()


def test_a_user_version_and_days(spark, facts, stored):
    sk = facts.where("user_id = 'U11'").first().user_sk
    orders = stored.withColumnRenamed("event_date", "folder")
    for since, until in ((None, None), ("2024-01-02", None), ("2024-01-01", "2024-01-01")):
        found, read = rows_read(spark, lookups.user_orders(orders, sk, since, until))
        own = facts.where(F.col("user_sk") == sk)
        own = own.where(F.col("event_date") >= (since or "2000-01-01"))
        assert found == own.where(F.col("event_date") <= (until or "2100-01-01")).count()
        assert read < ROWS / 5


def test_filters_are_written_and_rows_are_whole(spark, folder, facts):
    path = folder("table")
    replace_table(facts, path, "event_date", "event_timestamp", ("user_id",), ("session_id",))
    table = spark.read.parquet(path).select(*facts.columns)
    assert table.exceptAll(facts).isEmpty() and table.count() == ROWS
    assert lookup_options(()) == {}
    assert lookup_options(("a",))["parquet.bloom.filter.enabled#a"] == "true"


def test_a_user_lies_in_few_files(stored):
    """Of a day, one file per user, and several for those that share tasks with a large one."""
    files = stored.groupBy("user_id", "event_date").agg(
        F.count_distinct(F.col("_metadata.file_path")).alias("n")
    )
    assert files.where("user_id <> 'HOT' AND n = 1").count() > 0.9 * files.count()
    assert files.where("user_id = 'HOT'").agg(F.min("n")).first()[0] > 1


def test_lookups_push_literals_to_the_scan(spark, stored):
    plan = lookups.session_events(stored, "x", ["2024-01-01"])._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(session_id,x)" in plan and "PartitionFilters: [isnotnull(event_date" in plan

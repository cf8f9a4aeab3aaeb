"""Data-quality checks. Each returns rows, so failures can be joined, stored or counted."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.schemas import EVENT_TYPES, MAX_LENGTHS, PLATFORMS


class DataQualityError(ValueError):
    """A load was stopped before it was published."""


def _stack(df: DataFrame, pairs: Sequence[tuple[str, str]], extra: Sequence[str] = ()) -> DataFrame:
    """Turn one wide row of failure counts into a row per check."""
    items = ", ".join(f"'{label}', `{column}`" for label, column in pairs)
    return df.selectExpr(*extra, f"stack({len(pairs)}, {items}) AS (check, failing_rows)")


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column, all counted in one pass."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    rows = _stack(counts, [(f"not_null: {c}", c) for c in columns])
    return rows.select("check", (F.col("failing_rows") == 0).alias("passed"), "failing_rows")


def text_limits(
    df: DataFrame,
    longest: Mapping[str, int] = MAX_LENGTHS,
    patterns: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows whose text is too long or does not match its pattern, per column, in one pass.

    NULL passes. ``schemas.UUID_PATTERN`` is the pattern of ids that must be UUIDs.
    """
    bad = {f"max_length: {c}": F.length(c) > n for c, n in longest.items()}
    bad |= {f"pattern: {c}": ~F.col(c).rlike(p) for c, p in (patterns or {}).items()}
    counts = df.agg(*(F.count_if(cond).alias(f"c{i}") for i, cond in enumerate(bad.values())))
    rows = _stack(counts, [(label, f"c{i}") for i, label in enumerate(bad)])
    return rows.select("check", (F.col("failing_rows") == 0).alias("passed"), "failing_rows")


def duplicate_keys(df: DataFrame, columns: Sequence[str], nulls: str = "ignore") -> DataFrame:
    """Keys that occur more than once, with their count.

    ``nulls="value"`` treats NULL as one more value; ``"ignore"`` skips keys with a NULL.
    """
    if nulls not in ("ignore", "value"):
        raise ValueError(f"unknown nulls rule {nulls!r}")
    keyed = df.dropna(subset=list(columns)) if nulls == "ignore" else df
    return keyed.groupBy(*columns).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def duplicate_count(df: DataFrame, *columns: str) -> DataFrame:
    """Rows beyond the first of each key; every key with a NULL counts as a duplicate."""
    return df.agg((F.count("*") - F.count_distinct(*map(F.col, columns))).alias("duplicates"))


def unexpected_values(
    df: DataFrame, column: str, allowed: Sequence[str], null_is_invalid: bool = False
) -> DataFrame:
    """Values outside the allowed set with their row counts."""
    bad = ~F.col(column).isin(list(allowed))
    if null_is_invalid:
        bad = F.col(column).isNull() | bad
    return df.where(bad).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def orphans(facts: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Fact keys missing from the dimension, with their row counts.

    Facts are reduced to one row per key first, so a frequent key costs nothing extra.
    """
    per_key = facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    known = dim.select(F.col(dim_key or key).alias(key))
    return per_key.join(known, key, "left_anti")


def violations(df: DataFrame, rule: Column) -> DataFrame:
    """Rows for which the rule is false; an unknown result passes."""
    return df.where(~rule)


def freshness(
    df: DataFrame,
    as_of: datetime,
    ts: str = "event_timestamp",
    warn_hours: int = 12,
    error_hours: int = 24,
) -> DataFrame:
    """Age of the newest row: ``pass``, ``warn`` or ``error``; a table without rows is an error."""
    now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    newest = df.agg(F.max(ts).alias("newest"))
    age = F.timestamp_diff("MICROSECOND", F.col("newest"), now) / F.lit(1_000_000.0)
    status = (
        F.when(F.col("newest").isNull() | (F.col("age_seconds") > error_hours * 3600), "error")
        .when(F.col("age_seconds") > warn_hours * 3600, "warn")
        .otherwise("pass")
    )
    return newest.withColumn("age_seconds", age).withColumn("status", status)


def row_count_drift(
    df: DataFrame, day: str = "event_date", threshold: float = 0.30, back: int = 7
) -> DataFrame:
    """Days whose row count is off the mean of up to ``back`` earlier days by more than the share."""
    daily = df.groupBy(day).agg(F.count("*").alias("row_count"))
    # One row per day reaches this window.
    earlier = W.orderBy(day).rowsBetween(-back, -1)
    gap = F.abs(F.col("row_count") - F.col("baseline_7d_avg"))
    return (
        daily.withColumn("baseline_7d_avg", F.avg("row_count").over(earlier))
        .withColumn("drift_ratio", gap / F.nullif(F.col("baseline_7d_avg"), F.lit(0.0)))
        .where(F.col("drift_ratio") > threshold)
    )


def event_suite(
    df: DataFrame,
    key: str = "event_id",
    required: Sequence[str] = ("event_id", "user_id", "event_type", "event_timestamp"),
    category: str = "event_type",
    allowed: Sequence[str] = EVENT_TYPES,
    amount: str = "amount",
    floor: int | None = None,
) -> DataFrame:
    """The expectation report of a batch: one row per check plus totals and overall flag.

    One pass for the counts, one shuffle of the key for uniqueness and one of the unexpected
    values, each counted once per task. A message holds the failures' number or, for the set of
    values, the values themselves: all of them up to ``_SHOWN``, beyond that the first by name
    and how many more there are. ``floor`` adds a check on the number of rows.
    """
    counts = df.agg(
        F.count("*").alias("total_records"),
        *(F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required),
        F.count_if(F.col(amount) < 0).alias("negative"),
        *([F.greatest(F.lit(floor) - F.count("*"), F.lit(0)).alias("missing")] if floor else []),
    )
    pairs = [
        *((f"expect_column_values_to_not_be_null: {c}", f"null_{c}") for c in required),
        (f"expect_column_values_to_be_between: {amount} >= 0", "negative"),
        *([("expect_table_row_count_to_be_at_least", "missing")] if floor else []),
    ]
    said = F.lit(None).cast("string").alias("listed")
    scalar = _stack(counts, pairs, ["total_records"]).select("total_records", said, "check", "failing_rows")
    # A NULL key counts as one value, so only its repeats are duplicates.
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    unique = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        said,
        F.lit(f"expect_column_values_to_be_unique: {key}").alias("check"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("failing_rows"),
    )
    whole = W.partitionBy()
    failures = F.col("failing_rows").cast("string")
    message = F.concat(F.lit("Rows missing: "), failures)
    for name, said in (
        ("expect_column_values_to_be_unique", F.concat(F.lit("Duplicates found: "), failures)),
        ("expect_column_values_to_be_in_set", F.col("listed")),
        ("expect_column_values_to_be_between", F.concat(F.lit("Negative amounts detected: "), failures)),
    ):
        message = F.when(F.col("check").startswith(name), said).otherwise(message)
    nulls = F.col("check").startswith("expect_column_values_to_not_be_null: ")
    column = F.substring_index("check", ": ", -1)
    message = F.when(nulls, F.concat(F.lit("Null count in "), column, F.lit(": "), failures)).otherwise(message)
    rows = scalar.unionByName(unique).unionByName(_value_row(df, category, allowed))
    return rows.select(
        F.lit("product_events_core_expectations").alias("suite_name"),
        F.max("total_records").over(whole).alias("total_records"),
        (F.max("failing_rows").over(whole) == 0).alias("checks_passed"),
        "check",
        (F.col("failing_rows") == 0).alias("passed"),
        "failing_rows",
        message.alias("message"),
    )


_SHOWN = 1000  # unexpected values in a message


def _value_row(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """The row of the check on a set of values; its list holds the first ``_SHOWN``, NULL as such."""
    bad = unexpected_values(df, column, allowed, null_is_invalid=True).select(
        F.coalesce(F.col("value").cast("string"), F.lit("NULL")).alias("value"), "n"
    )
    none = F.lit(None).cast("bigint")
    # The first ones are picked per task before they meet; the others are only counted.
    first = bad.orderBy("value").limit(_SHOWN).select("value", none.alias("values"), none.alias("n"))
    sums = bad.agg(F.count("*").alias("values"), F.sum("n").alias("n"))
    both = first.unionByName(sums.select(F.lit(None).cast("string").alias("value"), "values", "n"))
    shown = F.concat_ws(", ", F.sort_array(F.collect_list("value")))
    rest = F.max("values") - F.count("value")
    more = F.when(rest > 0, F.concat(F.lit(" and "), rest.cast("string"), F.lit(" more"))).otherwise(F.lit(""))
    label = f"Unexpected {column.replace('_', ' ')}s: "
    return both.agg(
        none.alias("total_records"),
        F.concat(F.lit(label), F.lit("{"), shown, F.lit("}"), more).alias("listed"),
        F.lit(f"expect_column_values_to_be_in_set: {column}").alias("check"),
        F.coalesce(F.max("n"), F.lit(0)).alias("failing_rows"),
    )


def gate_report(
    df: DataFrame,
    key: str | Sequence[str] = "event_id",
    required: Sequence[str] = ("user_id", "event_timestamp"),
    amount: str | None = None,
    categories: dict[str, Sequence[str]] | None = None,
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row: rows with a missing required value, duplicate keys and optional extra counts.

    ``extra`` adds a count of the rows for which a condition holds, per name.
    """
    keys = [key] if isinstance(key, str) else list(key)
    missing = F.lit(False)
    for column in required:
        missing = missing | F.col(column).isNull()
    counts = {"missing_required": F.count_if(missing)}
    if amount:
        counts["negative_amounts"] = F.count_if(F.col(amount) < 0)
    for column, allowed in (categories or {}).items():
        counts[f"unexpected_{column}"] = F.count_if(~F.col(column).isin(list(allowed)))
    counts |= {name: F.count_if(bad) for name, bad in (extra or {}).items()}
    zero = F.lit(0).cast("bigint")
    # Only the key is shuffled for its distinct count; the other counts need no shuffle.
    scalar = df.agg(*(c.alias(n) for n, c in counts.items())).withColumn("duplicate_keys", zero)
    repeats = duplicate_count(df, *keys).select(
        *(zero.alias(n) for n in counts), F.col("duplicates").alias("duplicate_keys")
    )
    both = scalar.unionByName(repeats)
    return both.agg(*(F.sum(c).alias(c) for c in both.columns))


def gate(df: DataFrame, label: str = "batch", **rules) -> dict[str, int]:
    """Raise ``DataQualityError`` when any gate count is above zero; else return the counts."""
    counts = gate_report(df, **rules).first().asDict()
    failed = {name: n for name, n in counts.items() if n}
    if failed:
        listed = ", ".join(f"{name}={n}" for name, n in sorted(failed.items()))
        raise DataQualityError(f"{label}: {listed}")
    return counts


STAGING_RULES = {
    "required": ("event_id", "user_id", "event_timestamp", "country", "platform"),
    "amount": "amount",
    "categories": {"event_type": EVENT_TYPES, "platform": PLATFORMS},
}


@dataclass(frozen=True)
class TableRules:
    """The tests declared for one table."""

    required: Sequence[str] = ()
    # Columns, or tuples of columns that are unique together.
    unique: Sequence[str | tuple[str, ...]] = ()
    accepted: Mapping[str, Sequence[str]] = field(default_factory=dict)
    not_negative: Sequence[str] = ()
    # Column -> (parent table, parent column).
    parents: Mapping[str, tuple[str, str]] = field(default_factory=dict)


# The tests the warehouse tables and the staged events must pass.
WAREHOUSE_RULES = {
    "dim_user": TableRules(required=("user_sk", "user_id", "is_current"), unique=("user_sk",)),
    "fact_events": TableRules(
        required=("event_id", "user_sk", "event_date"),
        unique=("event_id", ("event_date", "event_id")),
        accepted={"platform": PLATFORMS},
        parents={"user_sk": ("dim_user", "user_sk")},
    ),
    "fact_orders": TableRules(
        required=("order_id", "order_amount"),
        unique=("order_id", ("order_date", "order_id")),
        not_negative=("order_amount",),
    ),
    "stg_events": TableRules(
        required=("event_id", "user_id", "event_type", "event_timestamp"),
        unique=("event_id",),
        accepted={"event_type": EVENT_TYPES},
    ),
}


def _rule_rows(table: str, tables: Mapping[str, DataFrame], rules: TableRules) -> list[DataFrame]:
    df = tables[table]
    counts = {f"not_null: {c}": F.col(c).isNull() for c in rules.required}
    counts |= {
        f"accepted_values: {c}": ~F.col(c).isin(list(allowed))
        for c, allowed in rules.accepted.items()
    }
    counts |= {f"not_negative: {c}": F.col(c) < 0 for c in rules.not_negative}
    scalar = df.agg(*(F.count_if(bad).alias(f"c{i}") for i, bad in enumerate(counts.values())))
    parts = [_stack(scalar, [(label, f"c{i}") for i, label in enumerate(counts)])]
    for key in rules.unique:
        columns = [key] if isinstance(key, str) else list(key)
        repeated = duplicate_keys(df, columns).agg(F.count("*").alias("failing_rows"))
        label = f"unique: {', '.join(columns)}"
        parts.append(repeated.select(F.lit(label).alias("check"), "failing_rows"))
    for column, (parent, parent_column) in rules.parents.items():
        lost = orphans(df, tables[parent], column, parent_column)
        lost = lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failing_rows"))
        parts.append(lost.select(F.lit(f"relationships: {column}").alias("check"), "failing_rows"))
    return [part.select(F.lit(table).alias("checked_table"), "*") for part in parts]


def declared_checks(
    tables: Mapping[str, DataFrame], rules: Mapping[str, TableRules] = WAREHOUSE_RULES
) -> DataFrame:
    """Every declared test of the given tables: one row each, with its failures.

    Missing values, value sets and signs of a table share one pass. ``unique``
    counts values that occur more than once, the other tests count rows.
    """
    parts = [
        part
        for table in tables
        if table in rules
        for part in _rule_rows(table, tables, rules[table])
    ]
    rows = reduce(DataFrame.unionByName, parts)
    return rows.select(
        "checked_table", "check", (F.col("failing_rows") == 0).alias("passed"), "failing_rows"
    )

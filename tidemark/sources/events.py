"""The raw event lake: ``date=YYYY-MM-DD`` folders of Parquet or JSON lines."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import utc_timestamp
from tidemark.functions.days import as_date
from tidemark.schemas import MONEY, RAW_EVENT
from tidemark.sources.footers import column_footer, file_footers, listed_files
from tidemark.sources.sinks import path_exists

PARTITION = "date"
# Added to raw rows on demand: where they come from, and a line that could not be parsed.
SOURCE = "_source_file"
CORRUPT = "_corrupt_line"
# JSON lines that our own sink puts together end in .txt.
LAKE_GLOBS = {"parquet": "*.parquet", "json": "*.{json,txt}"}
PARTITION_FIELD = T.StructField(PARTITION, T.DateType())
_LAKE = T.StructType([*RAW_EVENT.fields, PARTITION_FIELD])
_CORRUPT_FIELD = T.StructField(CORRUPT, T.StringType())


def _scan(spark: SparkSession, root: str, fmt: str, source: bool = False) -> DataFrame:
    if fmt not in LAKE_GLOBS:
        raise ValueError(f"unknown event format {fmt!r}")
    if fmt == "json" and source:
        # Lines that cannot be parsed become rows that hold their text.
        schema = T.StructType([*RAW_EVENT.fields, _CORRUPT_FIELD, PARTITION_FIELD])
        reader = spark.read.schema(schema).option("mode", "PERMISSIVE")
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    else:
        reader = spark.read.schema(_LAKE)
        if fmt == "json":
            reader = reader.option("mode", "FAILFAST")
    # A folder may hold both formats; each reader takes its own files only.
    return reader.option("pathGlobFilter", LAKE_GLOBS[fmt]).format(fmt).load(root)


def _with_source(rows: DataFrame) -> DataFrame:
    """Raw rows with :data:`SOURCE` and :data:`CORRUPT`."""
    corrupt = F.col(CORRUPT) if CORRUPT in rows.columns else F.lit(None).cast("string")
    names = _LAKE.fieldNames()
    return rows.select(*names, F.col("_metadata.file_path").alias(SOURCE), corrupt.alias(CORRUPT))


def lake_footers(
    spark: SparkSession, root: str, days: Iterable[date | str] | None = None
) -> DataFrame:
    """``path, length, date, n_rows, columns`` of the lake's Parquet files, see ``file_footers``."""
    files = listed_files(spark, root, LAKE_GLOBS["parquet"], [PARTITION_FIELD])
    if days is not None:
        files = files.where(F.col(PARTITION).isin([as_date(d) for d in days]))
    return file_footers(files, RAW_EVENT.fieldNames())


def _untyped(footers: DataFrame) -> tuple[list[date], list[str]]:
    """Days in whose files ``product_id`` has no text type, and such files of other days.

    A column without any value may have been written with another type. Footers have been
    read by tasks; what reaches the driver are days and, of days that hold both kinds, the
    odd files.
    """
    kind = column_footer("product_id")["kind"]
    odd = kind.isNotNull() & ~kind.rlike("string|binary|utf8")
    per_day = footers.groupBy(PARTITION).agg(
        F.count_if(~odd | odd.isNull()).alias("typed"), F.collect_list(F.when(odd, F.col("path"))).alias("odd")
    )
    rows = per_day.where(F.size("odd") > 0).select(
        PARTITION, F.when(F.col("typed") > 0, F.col("odd")).alias("odd")
    )
    found = rows.collect()
    whole = [r[PARTITION] for r in found if r.odd is None]
    return whole, sorted(p for r in found if r.odd is not None for p in r.odd)


def read_raw(
    spark: SparkSession,
    root: str,
    fmt: str = "parquet",
    days: Iterable[date | str] | None = None,
    typed: bool = False,
    source: bool = False,
) -> DataFrame:
    """Raw lake rows with the declared schema plus the partition ``date``.

    ``days`` prunes to those partitions. Other writers may leave ``product_id``
    without a type in a file that has no purchase, so footers are looked at first;
    pass ``typed=True`` for a lake of our own sink to save that look. A JSON line that
    cannot be parsed stops the scan; with ``source`` it is a row without values, and all rows
    have two more columns, their file and the text of such a line.
    """
    wanted = None if days is None else [as_date(d) for d in days]
    lake = _scan(spark, root, fmt, source)
    if wanted is not None:
        lake = lake.where(F.col(PARTITION).isin(wanted))
    whole, files = ([], []) if typed or fmt == "json" else _untyped(lake_footers(spark, root, wanted))
    if not whole and not files:
        return _with_source(lake) if source else lake
    # What is odd holds no product at all: read every other column from it.
    # Local paths come as file:/ while files are pruned and as file:/// in rows.
    skipped = sorted({*files, *(p.replace("file:/", "file:///") for p in files if not p.startswith("file://"))})
    typed_rows = ~F.col(PARTITION).isin(whole)
    if skipped:
        typed_rows = typed_rows & ~F.col("_metadata.file_path").isin(skipped)
    rest = T.StructType([f for f in _LAKE.fields if f.name != "product_id"])
    without = (
        spark.read.schema(rest)
        .option("basePath", root)
        .option("pathGlobFilter", LAKE_GLOBS["parquet"])
        .parquet(*(f"{root}/{PARTITION}={d}" for d in whole), *files)
        .withColumn("product_id", F.lit(None).cast("string"))
    )
    parts = (lake.where(typed_rows), without)
    if source:
        return _with_source(parts[0]).unionByName(_with_source(parts[1]))
    return parts[0].unionByName(parts[1].select(*_LAKE.fieldNames()))


def typed_columns(timestamp: Column | None = None) -> list[Column]:
    """The typed projection of a raw event, in the declared column order."""
    ts = utc_timestamp(F.col("event_timestamp")) if timestamp is None else timestamp
    return [
        F.col("event_id"),
        F.col("user_id"),
        F.col("event_type"),
        ts.alias("event_timestamp"),
        F.col("event_date").try_cast("date").alias("event_date"),
        F.col("platform"),
        F.col("country"),
        F.col("product_id"),
        F.col("amount").try_cast(MONEY).alias("amount"),
        F.col("session_id"),
        F.col("metadata"),
    ]


def rejects(raw: DataFrame | None = None) -> dict[str, Column]:
    """Per reason: raw rows that staging could not hold as they are.

    A NULL where the raw value is present is a failed cast; a day unlike the row's folder
    or time would put it where no reader looks for it. Lines that could not be parsed count
    where ``raw`` has them.
    """
    day = F.col("event_date").try_cast("date")
    at = utc_timestamp(F.col("event_timestamp"))
    lost = F.col("amount").isNotNull() & F.col("amount").try_cast(MONEY).isNull()
    reasons = {
        "event_date": day.isNull(),
        "event_date_unlike_folder": F.coalesce(day != F.col(PARTITION), F.lit(False)),
        "event_timestamp": at.isNull(),
        "time_outside_day": F.coalesce(F.to_date(at) != day, F.lit(False)),
        "amount": lost,
        "event_type": F.col("event_type").isNull(),
    }
    if raw is not None and CORRUPT in raw.columns:
        reasons["corrupt_line"] = F.col(CORRUPT).isNotNull()
    return reasons


def rejected_rows(raw: DataFrame) -> DataFrame:
    """How many raw rows of a lake fail for each reason; a row can fail for several."""
    reasons = rejects(raw)
    counts = raw.agg(*(F.count_if(bad).alias(n) for n, bad in reasons.items()))
    pairs = ", ".join(f"'{n}', `{n}`" for n in reasons)
    return counts.selectExpr(f"stack({len(reasons)}, {pairs}) AS (reason, failing_rows)")


def quarantined(raw: DataFrame) -> DataFrame:
    """``reasons, file, record, date`` of each raw row, read with ``source``, that staging cannot hold.

    ``record`` is the line itself where it could not be parsed, else the row as JSON.
    """
    reasons = F.filter(
        F.array(*(F.when(bad, F.lit(name)) for name, bad in rejects(raw).items())), lambda r: r.isNotNull()
    )
    record = F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*RAW_EVENT.fieldNames())))
    rows = raw.select(reasons.alias("reasons"), F.col(SOURCE).alias("file"), record.alias("record"), PARTITION)
    return rows.where(F.size("reasons") > 0)


def day_exists(spark: SparkSession, root: str, day: date | str, fmt: str = "parquet") -> bool:
    """Whether the lake has a folder for the day, be it with or without rows."""
    if fmt not in LAKE_GLOBS:
        raise ValueError(f"unknown event format {fmt!r}")
    return path_exists(spark, f"{root}/{PARTITION}={as_date(day)}")


def read_events(
    spark: SparkSession,
    root: str,
    fmt: str = "parquet",
    days: Iterable[date | str] | None = None,
    typed: bool = False,
) -> DataFrame:
    """Typed events over the whole lake, or over the given days."""
    return read_raw(spark, root, fmt, days, typed).select(*typed_columns())


def read_day(
    spark: SparkSession,
    root: str,
    day: date | str,
    fmt: str = "parquet",
    typed: bool = False,
    source: bool = False,
) -> DataFrame:
    """Raw rows of one ``date=`` folder; no rows when the folder is missing."""
    return read_raw(spark, root, fmt, [day], typed, source)


def partition_inventory(spark: SparkSession, root: str, rows: bool = True) -> DataFrame:
    """Files, bytes and rows per day and format, for both formats of the lake.

    Files are listed, so one without rows counts as well; Parquet rows come from file
    footers. A day without files yields no row. ``rows=False`` opens no file at all.
    """
    parts = []
    for fmt, glob in LAKE_GLOBS.items():
        listed = listed_files(spark, root, glob, [PARTITION_FIELD])
        per_day = listed.groupBy(PARTITION).agg(
            F.count("*").alias("n_files"), F.sum("length").alias("n_bytes")
        )
        if rows:
            counted = _scan(spark, root, fmt).groupBy(PARTITION).agg(F.count("*").alias("n_rows"))
            per_day = per_day.join(counted, PARTITION, "left").fillna(0, ["n_rows"])
        parts.append(per_day.select(PARTITION, F.lit(fmt).alias("format"), *per_day.columns[1:]))
    return parts[0].unionByName(parts[1])

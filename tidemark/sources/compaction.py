"""Merge a lake's small files, day by day, into files of a fair size."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.days import as_date
from tidemark.sources.events import LAKE_GLOBS, PARTITION, PARTITION_FIELD, SOURCE, read_raw
from tidemark.sources.footers import listed_files
from tidemark.sources.sinks import (
    delete_path,
    file_names,
    path_exists,
    read_text,
    rename_path,
    write_text,
)

TARGET = 256 << 20  # bytes of small files that become one file
_JOURNAL = "_compaction"
# Days whose files are rewritten by one job.
_DAYS_AT_ONCE = 32


def _plain(path: Column) -> Column:
    """Listings and scans write local paths with one and with three slashes."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def plan_bins(files: DataFrame, target: int = TARGET) -> DataFrame:
    """``path, date, bin`` of the files to merge, given ``path, length, date``.

    Files below half of ``target`` are small; those of a day are put into bins in the order of
    their names, each of about ``target`` bytes. A bin of one file is left as it is. A window
    sees the files of one day.
    """
    in_day = W.partitionBy(PARTITION).orderBy("path").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("length").over(in_day), F.lit(0))
    binned = files.where(F.col("length") < target // 2).withColumn("bin", F.floor(before / target))
    mates = F.count("*").over(W.partitionBy(PARTITION, "bin"))
    return binned.withColumn("mates", mates).where(F.col("mates") > 1).select("path", PARTITION, "bin")


def compact_lake(
    spark: SparkSession,
    root: str,
    fmt: str = "parquet",
    days: Iterable[date | str] | None = None,
    target: int = TARGET,
) -> dict[date, tuple[int, int]]:
    """Merge small files; returns per changed day how many files there were of them and are now.

    Rows stay the same and get the declared types. Merged files are written beside the lake,
    then a journal names them and the files they replace, and only then files are swapped: a
    run that breaks off is finished by the next one, so nothing is lost or doubled for good. While a day is
    swapped, its rows can be seen twice. Do not write a day while it is compacted.
    """
    _finish(spark, root)
    files = listed_files(spark, root, LAKE_GLOBS[fmt], [PARTITION_FIELD])
    if days is not None:
        files = files.where(F.col(PARTITION).isin([as_date(d) for d in days]))
    bins = plan_bins(files, target)
    counts = {r[PARTITION]: r["count"] for r in bins.groupBy(PARTITION).count().collect()}
    done = {}
    for group in _groups(sorted(counts)):
        done |= _compact_days(spark, root, fmt, bins, group, counts)
    return done


def _groups(days: list[date]) -> Iterator[list[date]]:
    for i in range(0, len(days), _DAYS_AT_ONCE):
        yield days[i : i + _DAYS_AT_ONCE]


def _compact_days(
    spark: SparkSession, root: str, fmt: str, bins: DataFrame, days: list[date], counts: dict[date, int]
) -> dict[date, tuple[int, int]]:
    own = bins.where(F.col(PARTITION).isin(days))
    old = [r.path for r in own.select("path").collect()]
    run = f"{_JOURNAL}/{uuid.uuid4().hex}"
    staged = f"{root}/{run}"
    wanted = own.select(_plain(F.col("path")).alias("__file"), F.col("bin").alias("__bin"))
    if fmt == "parquet":
        rows = read_raw(spark, root, fmt, days, source=True).withColumn("__file", _plain(F.col(SOURCE)))
        out = rows.join(wanted, "__file").drop("__file")
        # One task, and so one file, per day and bin.
        dealt = out.repartition(len(old), PARTITION, "__bin").sortWithinPartitions(PARTITION, "__bin", "event_timestamp")
        kept = [c for c in dealt.columns if not c.startswith("_")]
        dealt.select(*kept).write.partitionBy(PARTITION).option("compression", "snappy").parquet(staged)
    else:
        # Lines go over as they are, also those that are no JSON.
        lines = spark.read.option("pathGlobFilter", LAKE_GLOBS[fmt]).text(root).where(F.col(PARTITION).isin(days))
        lines = lines.withColumn("__file", _plain(F.col("_metadata.file_path")))
        out = lines.join(wanted, "__file")
        dealt = out.repartition(len(old), PARTITION, "__bin").sortWithinPartitions(PARTITION)
        dealt.select("value", PARTITION).write.partitionBy(PARTITION).text(staged)
    new = {
        str(day): sorted(n for n in file_names(spark, f"{staged}/{PARTITION}={day}") if n[0] not in "._")
        for day in days
    }
    journal = {"staged": run, "new": new, "old": [p.rpartition(f"{PARTITION}=")[2] for p in old]}
    draft = f"{root}/{_JOURNAL}/_draft-{uuid.uuid4().hex}"
    write_text(spark, draft, json.dumps(journal))
    rename_path(spark, draft, f"{staged}.json")
    _finish(spark, root)
    return {day: (counts[day], len(new[str(day)])) for day in days}


def _finish(spark: SparkSession, root: str) -> None:
    """Swap what a journal names; steps that have been taken already are passed over."""
    folder = f"{root}/{_JOURNAL}"
    names = file_names(spark, folder)
    for name in sorted(n for n in names if n.endswith(".json")):
        journal = json.loads(read_text(spark, f"{folder}/{name}"))
        for day, files in journal["new"].items():
            for file in files:
                staged = f"{root}/{journal['staged']}/{PARTITION}={day}/{file}"
                if path_exists(spark, staged):
                    rename_path(spark, staged, f"{root}/{PARTITION}={day}/{file}")
        for file in journal["old"]:
            delete_path(spark, f"{root}/{PARTITION}={file}")
        delete_path(spark, f"{folder}/{name}")
    # What no journal names was never to be seen.
    delete_path(spark, folder)

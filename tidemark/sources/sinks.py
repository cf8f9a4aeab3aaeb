"""Day-partitioned sinks for the lake and the warehouse."""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import to_json_text
from tidemark.schemas import RAW_EVENT


def _spread(df: DataFrame, *parts: str) -> DataFrame:
    # Rebalance, unlike repartition, splits a day that outgrows one task and
    # merges small ones, so neither huge tasks nor tiny files come out.
    return df.hint("rebalance", *parts)


def lookup_options(columns: Iterable[str]) -> dict[str, str]:
    """Parquet options by which readers skip row groups without a wanted value.

    A bloom filter per row group and column, as large as the column's distinct values ask for.
    Spark uses them for equality with literals; columns with few values have a dictionary
    instead, which serves the same way.
    """
    options = {f"parquet.bloom.filter.enabled#{name}": "true" for name in columns}
    return options | ({"parquet.bloom.filter.adaptive.enabled": "true"} if options else {})


def raw_rows(df: DataFrame) -> DataFrame:
    """Typed events as lake rows: ISO text timestamps, day text and JSON metadata."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    iso = F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    special = {
        "event_timestamp": F.concat(iso, F.lit("Z")),
        "event_date": F.date_format("event_date", "yyyy-MM-dd"),
        "metadata": to_json_text(F.col("metadata"), kinds["metadata"]),
    }
    cols = []
    for field in RAW_EVENT.fields:
        value = special.get(field.name, F.col(field.name))
        cols.append(value.cast(field.dataType).alias(field.name))
    return df.select(*cols)


def write_parquet_lake(df: DataFrame, root: str) -> None:
    """Append lake rows as Snappy Parquet under ``date=`` folders."""
    out = raw_rows(df).withColumn("date", F.to_date("event_date"))
    (
        _spread(out, "date")
        .sortWithinPartitions("date", "event_timestamp")
        .write.partitionBy("date")
        .option("compression", "snappy")
        .mode("append")
        .parquet(root)
    )


def write_json_lake(df: DataFrame, root: str) -> None:
    """Append lake rows as JSON lines under ``date=`` folders.

    Metadata is written as a nested value, its text unchanged. Text that no JSON line can
    hold as such, for it is not JSON or breaks the line, is written as a JSON string and
    reads back the same. The files end in ``.txt``, since their lines are put together here.
    """
    out = raw_rows(df).withColumn("date", F.to_date("event_date"))
    others = [c for c in out.columns if c not in ("metadata", "date")]
    rest = F.to_json(F.struct(*others), {"ignoreNullFields": "false"})
    quoted = F.to_json(F.struct("metadata"))
    text = F.col("metadata")
    nested = F.try_parse_json(text).isNotNull() & text.rlike(r"^\s*\{") & ~text.contains("\n") & ~text.contains("\r")
    value = F.when(text.isNull(), F.lit('{"metadata":null}')).when(
        nested, F.concat(F.lit('{"metadata":'), text, F.lit("}"))
    ).otherwise(quoted)
    line = F.concat(F.expr("substring(rest, 1, length(rest) - 1)"), F.lit(","), F.expr("substring(value, 2)"))
    lines = out.select("date", rest.alias("rest"), value.alias("value")).select(line.alias("value"), "date")
    _spread(lines, "date").write.partitionBy("date").mode("append").text(root)


def _located(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, located = _located(spark, path)
    return fs.exists(located)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, located = _located(spark, path)
    fs.delete(located, True)


def rename_path(spark: SparkSession, path: str, target: str) -> bool:
    """Give a file its name; False when there already is one of that name."""
    fs, located = _located(spark, path)
    if path_exists(spark, target):
        return False
    return fs.rename(located, _located(spark, target)[1])


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file of the driver's."""
    fs, located = _located(spark, path)
    out = fs.create(located, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """Read a small file to the driver."""
    fs, located = _located(spark, path)
    stream = fs.open(located)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def partition_days(spark: SparkSession, path: str, part_col: str) -> list[date]:
    """The days of a table's partitions, by its folders; no file is opened."""
    day = re.compile(rf"{re.escape(part_col)}=(\d{{4}}-\d{{2}}-\d{{2}})")
    found = (day.fullmatch(name) for name in file_names(spark, path))
    return sorted(date.fromisoformat(m[1]) for m in found if m)


def replace_table(
    df: DataFrame,
    path: str,
    part_col: str,
    sort_col: str,
    cluster: Iterable[str] = (),
    lookup: Iterable[str] = (),
) -> None:
    """Replace a whole table: partitions that ``df`` does not hold are gone afterwards.

    ``cluster`` and ``lookup`` are those of :func:`overwrite_partitions`.
    """
    (
        _spread(df, part_col, *cluster)
        .sortWithinPartitions(part_col, sort_col)
        .write.mode("overwrite")
        .options(**lookup_options(lookup))
        .option("partitionOverwriteMode", "static")
        .partitionBy(part_col)
        .parquet(path)
    )


def file_names(spark: SparkSession, path: str) -> set[str]:
    """Names in a folder; none when it is missing."""
    fs, located = _located(spark, path)
    return {s.getPath().getName() for s in fs.listStatus(located)} if fs.exists(located) else set()


def overwrite_partitions(
    df: DataFrame,
    path: str,
    part_col: str,
    days: Iterable[date | str] = (),
    sort_col: str | None = None,
    spread: bool = True,
    cluster: Iterable[str] = (),
    lookup: Iterable[str] = (),
) -> None:
    """Replace the partitions ``df`` holds, and empty those of ``days`` it does not.

    Rows are sorted by ``sort_col`` inside each file, so that range filters on it
    skip row groups. Rows of one ``cluster`` value lie together in one file of a day, or in a
    few where they outgrow it, and the ``lookup`` columns get filters by which a literal
    lookup skips the other files. Rerunning with the same rows leaves the same table. Pass
    ``spread=False`` for one day whose rows already are in tasks of a fair size.
    """
    spark = df.sparkSession
    folders = {f"{path}/{part_col}={day}" for day in days}
    before = {folder: file_names(spark, folder) for folder in folders}
    out = _spread(df, part_col, *cluster) if spread else df
    out = out.sortWithinPartitions(part_col, *([sort_col] if sort_col else []))
    (
        out.write.mode("overwrite")
        .options(**lookup_options(lookup))
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(part_col)
        .parquet(path)
    )
    # A dynamic overwrite leaves a day without new rows as it was; files that
    # are all still there show that, and such a day must end up empty.
    for folder, names in before.items():
        if names and file_names(spark, folder) == names:
            delete_path(spark, folder)

"""What Parquet footers say, read by tasks, one row per file: no data page is opened."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LISTED = [
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
]
_FOOTER = (
    "file string, n_rows bigint, "
    "columns array<struct<name:string,kind:string,nulls:bigint,newest_micros:bigint>>"
)
# Files whose footers one task reads.
_PER_TASK = 64


def listed_files(spark: SparkSession, root: str, glob: str, parts: Sequence[T.StructField] = ()) -> DataFrame:
    """``path, length`` and the folder columns ``parts`` of the files under ``root``; none is opened."""
    reader = spark.read.format("binaryFile").schema(T.StructType([*_LISTED, *parts]))
    files = reader.option("pathGlobFilter", glob).load(root)
    return files.select("path", "length", *(p.name for p in parts))


def file_footers(files: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Add to ``files (path, …)`` its rows and, for each of ``columns`` that the file has, its type,
    NULL count and newest timestamp; the latter two are NULL where the footer does not say.

    Footers are read by the file systems that Arrow knows.
    """
    wanted = set(columns)

    # Local, so that tasks need no more than pyarrow.
    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs
        from pyarrow import parquet as pq

        kinds = pa.struct(
            [("name", pa.string()), ("kind", pa.string()), ("nulls", pa.int64()), ("newest_micros", pa.int64())]
        )

        def column_of(meta, schema, at: int) -> dict:
            nulls, newest = 0, None
            for g in range(meta.num_row_groups):
                chunk = meta.row_group(g).column(at)
                stats = chunk.statistics
                known = stats is not None and stats.has_null_count
                nulls = None if nulls is None or not known else nulls + stats.null_count
                if stats is None or (not stats.has_min_max and chunk.num_values != (stats.null_count or 0)):
                    newest = -1
                elif stats.has_min_max and isinstance(stats.max, datetime) and newest != -1:
                    micros = round((stats.max.replace(tzinfo=None) - datetime(1970, 1, 1)).total_seconds() * 1e6)
                    newest = micros if newest is None else max(newest, micros)
            name = meta.schema.column(at).name
            return {
                "name": name,
                "kind": str(schema.field(name).type),
                "nulls": nulls,
                "newest_micros": None if newest == -1 else newest,
            }

        for batch in batches:
            out = []
            for path in batch.column(0).to_pylist():
                where, local = fs.FileSystem.from_uri(path)
                with where.open_input_file(local) as file:
                    parquet = pq.ParquetFile(file)
                    meta, schema = parquet.metadata, parquet.schema_arrow
                    places = [
                        i
                        for i in range(meta.num_columns)
                        if meta.schema.column(i).path in wanted
                    ]
                    out.append((path, meta.num_rows, [column_of(meta, schema, i) for i in places]))
            names, rows, found = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(rows, pa.int64()), pa.array(found, pa.list_(kinds))],
                ["file", "n_rows", "columns"],
            )

    n = files.count()
    spread = files.select("path").repartition(max(1, -(-n // _PER_TASK)))
    return files.join(spread.mapInArrow(read, _FOOTER), F.col("path") == F.col("file")).drop("file")


def column_footer(name: str) -> Column:
    """What :func:`file_footers` found for one column; NULL where the file has no such column."""
    return F.get(F.filter("columns", lambda c: c["name"] == F.lit(name)), F.lit(0))

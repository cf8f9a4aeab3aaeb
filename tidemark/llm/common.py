"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from contextlib import suppress
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tidemark

# White space between words: a blank and the controls 9 to 13.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, so that tasks can import it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(tidemark.__file__).parent
    bundle = Path(tempfile.mkdtemp(prefix="tidemark-code-")) / "tidemark_code.zip"
    with zipfile.ZipFile(bundle, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(bundle))
    _shipped.add(context.applicationId)


def map_batches(
    df: DataFrame,
    work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str | T.StructType,
) -> DataFrame:
    """``mapInArrow`` with this package present on the executors.

    A Python worker outlives its task, so each task hands back what it has freed.
    """

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()

    ship(df.sparkSession)
    return df.mapInArrow(tidy, schema)


def give_back() -> None:
    """Return memory that Python and Arrow have freed, but still hold, to the system."""
    pa.default_memory_pool().release_unused()
    # Of the C library on Linux; others have none.
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def id_and_text(docs: DataFrame, *more: str) -> DataFrame:
    """The two columns that most operators read; extra columns cannot clash with derived ones."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        *more,
    )


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words_of(text: Column) -> Column:
    """Words between runs of white space; NULL text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value`` with ``value`` computed once per row.

    A column that a lambda mentions is computed again for every element; bound to
    a lambda variable it is not.
    """
    return F.transform(F.array(value), body)[0]


def batches_of(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``size`` of the tuples."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: Sequence[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)

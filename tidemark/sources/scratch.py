"""Tables written to the shared checkpoint folder to fix a result once."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}
_made: dict[str, list[str]] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the session; a local one only where none is set."""
    root = spark.conf.get(_CONF, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_CONF} to a folder every executor can reach")
        app = spark.sparkContext.applicationId
        root = _local_roots.setdefault(app, "") or tempfile.mkdtemp(prefix="tidemark-")
        _local_roots[app] = root
    return root.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh, unused path under the shared folder."""
    path = f"{scratch_root(spark)}/tidemark/{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> None:
    """Delete the folders this application made, once no result needs them any more."""
    _delete(spark, _made.pop(spark.sparkContext.applicationId, []))


def _delete(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        located = spark._jvm.org.apache.hadoop.fs.Path(path)
        located.getFileSystem(spark._jsc.hadoopConfiguration()).delete(located, True)


@contextmanager
def releasing(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what was written to the shared folder in between.

    For work that publishes its results itself; no DataFrame may outlive it.
    """
    app = spark.sparkContext.applicationId
    before = set(_made.get(app, []))
    try:
        yield
    finally:
        own = [path for path in _made.get(app, []) if path not in before]
        _made[app] = [path for path in _made.get(app, []) if path in before]
        _delete(spark, own)


def pin(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The rows, and any value that depends on how they were split into tasks, are
    then fixed: later uses and retries after a lost executor see the same table.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

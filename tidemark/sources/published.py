"""Partitioned tables whose changes appear all at once.

Every load writes its partitions into a run folder of its own, ``<table>/run=…/<part>=…``, and
at its end one small state file that says, for every table, which run holds each partition.
Readers follow the newest state file, so before it is in place they see all that was there,
and afterwards all that is new; a load that fails leaves nothing behind but folders that no
state names. The state file has one entry per table and partition, like a catalogue.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.sources.sinks import (
    delete_path,
    file_names,
    read_text,
    rename_path,
    replace_table,
    write_text,
)

_STATES = "_states"
_NAME = re.compile(r"(\d{8})\.json")


class ConcurrentLoad(RuntimeError):
    """Another load has published in between."""


@dataclass
class State:
    """Which run holds each partition of each table."""

    number: int = 0
    tables: dict[str, dict[str, str]] = field(default_factory=dict)
    # Partition folders that the state before still names, to be deleted by the next one.
    replaced: list[str] = field(default_factory=list)

    def partitions(self, table: str) -> list[str]:
        return sorted(self.tables.get(table, {}))


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(m[1]) for n in file_names(spark, f"{root}/{_STATES}") if (m := _NAME.fullmatch(n)))


def read_state(spark: SparkSession, root: str) -> State:
    """The newest published state; an empty one where nothing was published."""
    numbers = _numbers(spark, root)
    if not numbers:
        return State()
    held = json.loads(read_text(spark, f"{root}/{_STATES}/{numbers[-1]:08d}.json"))
    return State(numbers[-1], held["tables"], held["replaced"])


def read_table(
    spark: SparkSession,
    root: str,
    table: str,
    schema: T.StructType,
    part: T.StructField,
    state: State | None = None,
) -> DataFrame:
    """The rows of a table as ``state``, else the newest one, has them; ``part`` comes last."""
    state = read_state(spark, root) if state is None else state
    fields = [f for f in schema.fields if f.name != part.name]
    whole = T.StructType([*fields, part])
    runs = state.tables.get(table, {})
    if not runs:
        return spark.createDataFrame([], whole)
    paths = [f"{root}/{table}/run={run}/{part.name}={value}" for value, run in sorted(runs.items())]
    reader = spark.read.schema(whole).option("basePath", f"{root}/{table}")
    return reader.parquet(*paths).select(*whole.fieldNames())


class Publication:
    """One load's changes; nothing is visible before :meth:`publish`.

    As a context manager it deletes what it wrote when it is left by an exception or without
    having published.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.before = read_state(spark, root)
        self.run = f"{self.before.number + 1:08d}-{uuid.uuid4().hex[:12]}"
        self.state = State(
            self.before.number + 1, {t: dict(p) for t, p in self.before.tables.items()}, []
        )
        self._written: set[str] = set()
        self._done = False

    def __enter__(self) -> Publication:
        return self

    def __exit__(self, *_) -> None:
        if not self._done:
            for table in self._written:
                delete_path(self.spark, self._folder(table))

    def _folder(self, table: str) -> str:
        return f"{self.root}/{table}/run={self.run}"

    def write(
        self,
        df: DataFrame,
        table: str,
        part: str,
        sort: str,
        only: Iterable[object] | None = None,
        cluster: Iterable[str] = (),
        lookup: Iterable[str] = (),
    ) -> None:
        """Stage ``df`` as the new content of the partitions ``only``, or of the whole table.

        Those of them that ``df`` does not hold are gone afterwards. Other partitions stay;
        ``df`` may hold none of them.
        """
        self._written.add(table)
        folder = self._folder(table)
        replace_table(df, folder, part, sort, cluster, lookup)
        prefix = f"{part}="
        values = [n.removeprefix(prefix) for n in file_names(self.spark, folder) if n.startswith(prefix)]
        held = self.state.tables.setdefault(table, {})
        if only is None:
            held.clear()
        else:
            names = {str(o) for o in only}
            if foreign := set(values) - names:
                raise ValueError(f"{table} has rows of {sorted(foreign)}, not only of {sorted(names)}")
            for name in names:
                held.pop(name, None)
        held |= {value: self.run for value in values}

    def drop(self, table: str, only: Iterable[object] | None = None) -> None:
        """The table, or those partitions of it, will hold nothing."""
        held = self.state.tables.get(table, {})
        for name in list(held) if only is None else [str(o) for o in only]:
            held.pop(name, None)

    def publish(self) -> None:
        """Make all staged changes visible, then delete what two states ago was replaced."""
        spark, root = self.spark, self.root
        gone = []
        for table, runs in self.before.tables.items():
            now = self.state.tables.get(table, {})
            for value, run in runs.items():
                if now.get(value) != run:
                    gone += self._partition_folders(table, value, run)
        self.state.replaced = gone
        text = json.dumps({"tables": self.state.tables, "replaced": gone}, sort_keys=True)
        target = f"{root}/{_STATES}/{self.state.number:08d}.json"
        draft = f"{root}/{_STATES}/_{self.run}"
        write_text(spark, draft, text)
        newest = max(_numbers(spark, root), default=0)
        if newest != self.before.number or not rename_path(spark, draft, target):
            delete_path(spark, draft)
            raise ConcurrentLoad(f"state {self.state.number} of {root} exists already")
        self._done = True
        for folder in self.before.replaced:
            delete_path(spark, folder)
        for number in _numbers(spark, root)[:-2]:
            delete_path(spark, f"{root}/{_STATES}/{number:08d}.json")

    def _partition_folders(self, table: str, value: str, run: str) -> list[str]:
        names = file_names(self.spark, f"{self.root}/{table}/run={run}")
        return [f"{self.root}/{table}/run={run}/{n}" for n in names if n.endswith(f"={value}")]

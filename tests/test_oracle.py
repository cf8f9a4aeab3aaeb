"""Every registered query against its SQL check on the small tables."""

import datetime
import decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from conftest import SF
from workload import checks, queries

TABLES = sorted(p.stem for p in Path(SF).glob("*.parquet"))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return con


def _plain(value):
    return float(value) if isinstance(value, decimal.Decimal) else value


def _rows(columns, names, rows):
    order = [names.index(c) for c in columns]
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    df = driver.queries()[name](spark, SF)
    found = [tuple(r) for r in df.collect()]
    result = duck.execute(driver.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    columns = sorted(names)
    assert _rows(columns, df.columns, found) == _rows(columns, names, result.fetchall())


def test_every_query_of_the_library_has_a_check():
    assert set(queries.queries()) == set(checks.CHECKS)
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry_is_the_stickiness_mart(spark):
    rows = driver.entry(spark).collect()
    assert len(rows) == 30
    assert rows[0].metric_date == datetime.date(2024, 1, 30)

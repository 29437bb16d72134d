"""Every registered query against DuckDB on the same tables."""

import math
import os

import duckdb
import pytest
from conftest import DATA

import __spark_entry__ as entry_point
from starload import oracles, registry

NAMES = sorted(registry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in sorted(os.listdir(DATA)):
        table = file.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{file}'")
    yield con
    con.close()


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)
    return a == b and type(a) is type(b)


def ordered(rows):
    return sorted(rows, key=lambda r: tuple(str(v) for v in r))


def test_every_query_has_sql():
    assert oracles.ORACLES.keys() == registry.queries().keys()
    assert registry.queries().keys() <= entry_point.queries().keys()
    assert entry_point.oracle_sql().keys() <= entry_point.queries().keys()


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = ordered(tuple(row[c] for c in columns) for row in df.collect())
    result = duck.execute(oracles.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expected = ordered(tuple(row[names.index(c)] for c in columns) for row in result.fetchall())
    assert len(got) == len(expected) > 0
    for a, b in zip(got, expected):
        assert all(map(same, a, b)), (a, b)


def test_entry(spark):
    assert not entry_point.entry(spark).isEmpty()

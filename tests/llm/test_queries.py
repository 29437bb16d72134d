"""Queries that SQL can express, against DuckDB on the same tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from starload.llm import registry

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in sorted(os.listdir(DATA)):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{file}'")
    yield con
    con.close()


def ordered(rows):
    return sorted(rows, key=lambda r: tuple(map(str, r)))


@pytest.mark.parametrize("name", sorted(registry.oracles()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = ordered(tuple(row[c] for c in columns) for row in df.collect())
    result = duck.execute(registry.oracles()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expected = ordered(tuple(row[names.index(c)] for c in columns) for row in result.fetchall())
    assert len(got) == len(expected) > 0
    assert got == expected


def test_every_operator_is_registered():
    names = entry_point.queries()
    assert {n.split("_")[0] for n in names} >= {f"op{k}" for k in range(1, 11)}
    assert "pipeline" in names

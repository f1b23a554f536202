"""Every query against its SQL twin in DuckDB, at the smallest scale."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for file in Path(sf).glob("*.parquet"):
        con.sql(f"create view {file.stem} as select * from '{file}'")
    return con


def clean(value):
    return None if isinstance(value, float) and math.isnan(value) else value


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    result = duck.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert sorted(result.columns) == columns
    at = [result.columns.index(c) for c in columns]
    got = sorted((tuple(clean(r[c]) for c in columns) for r in df.collect()), key=repr)
    want = sorted((tuple(clean(r[i]) for i in at) for r in result.fetchall()), key=repr)
    assert got == want


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() == 125

"""Every query with SQL gives the rows, names and types that DuckDB gives on the same tables."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from pulsetrail.catalog import ORACLES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return connection


def in_name_order(records, names):
    places = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in places) for r in records), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, duck, folder, name):
    df = entry_points.queries()[name](spark, folder)
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    assert sorted(df.columns) == sorted(names)
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    got = in_name_order([tuple(r) for r in df.collect()], df.columns)
    assert got == in_name_order(result.fetchall(), names)


def test_every_oracle_has_its_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["value", "type", "component"]
    assert df.select("component").distinct().count() == 25

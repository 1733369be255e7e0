"""Every registered query against its SQL, over the smallest data set."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from lading.plans import derived, oracle, registry

QUERIES = registry.QUERIES
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def connection(data):
    con = duckdb.connect()
    for name in os.listdir(data):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{data}/{name}'")
    return con


def test_every_query_has_its_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.items() <= contract.queries().items() and SQL.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, data, name):
    df = QUERIES[name](spark, data)
    cursor = connection.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    expected = sorted(map(repr, cursor.fetchall()))
    assert sorted(map(repr, map(tuple, df.select(*columns).collect()))) == expected
    assert expected


@pytest.mark.parametrize("name", derived.VIEWS)
def test_derived_view(spark, connection, data, name):
    df = derived.view(spark, data, name)
    cursor = connection.execute(derived.duckdb_text(name))
    columns = [c[0] for c in cursor.description]
    spark_rows = [tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in df.select(*columns).collect()]
    if name.endswith("ledger"):
        # Only the time differs in type: a point in time here, a local one there.
        spark_rows = [r[:2] for r in spark_rows]
        assert sorted(map(repr, spark_rows)) == sorted(repr(r[:2]) for r in cursor.fetchall())
    else:
        assert sorted(map(repr, spark_rows)) == sorted(map(repr, cursor.fetchall()))


def test_entry(spark):
    assert contract.entry(spark).columns[0] == "pickup_id"

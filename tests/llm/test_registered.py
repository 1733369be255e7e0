"""The training-data queries that have SQL, on the smallest data set."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from lading.llm.oracle import ORACLE_SQL
from lading.llm.queries import QUERIES


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query(spark, data, name):
    con = duckdb.connect()
    for table in os.listdir(data):
        con.execute(f"CREATE VIEW {table.removesuffix('.parquet')} AS SELECT * FROM '{data}/{table}'")
    cursor = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in cursor.description]
    frame = contract.queries()[name](spark, data)
    assert sorted(frame.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, frame.select(*columns).collect()))) == sorted(map(repr, cursor.fetchall()))


def test_fourteen_queries_are_registered():
    names = {n for n in contract.queries() if n.startswith("op") and n[2].isdigit()} | {"pipeline"}
    assert names == {*QUERIES, "pipeline"} and len(names) == 14
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}

"""Every registered query against its SQL in DuckDB, on the whole sf0.01 input."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from ordermill.plans.oracle import ORACLE_SQL
from ordermill.plans.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted([tuple(row[i] for i in order) for row in rows], key=repr)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_same_result(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    cursor = duck.execute(contract.oracle_sql()[name])
    expected = canonical([c[0] for c in cursor.description], cursor.fetchall())
    actual = canonical(df.columns, [tuple(row) for row in df.collect()])
    assert actual[0] == expected[0]
    assert len(actual[1]) == len(expected[1])
    for got, want in zip(actual[1], expected[1]):
        assert got == want


def test_names_match():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(contract.oracle_sql()) <= set(contract.queries())

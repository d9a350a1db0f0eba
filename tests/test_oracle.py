"""Every registered query against its DuckDB statement."""

import datetime
import decimal
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as registry

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
QUERIES, ORACLES = registry.core_queries(), registry.core_oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in sorted(os.listdir(SF_DIR)):
        table = name.removesuffix(".parquet")
        connection.sql(f"create view {table} as select * from '{SF_DIR}/{name}'")
    return connection


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def _plain(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return int(value) if isinstance(value, decimal.Decimal) else value


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_statement(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    want = duck.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    expected = _rows(want.columns, want.fetchall())
    assert expected
    assert _rows(got.columns, got.collect()) == expected


def test_entry_runs(spark):
    assert registry.entry(spark).columns == ["sport", "gold", "silver", "bronze", "total"]

"""The queries that SQL can express against their DuckDB statements."""

import duckdb
import pytest

from tallyloom.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_matches_statement(llm, name, sf):
    duck = duckdb.connect()
    for table in ("documents", "embeddings"):
        duck.sql(f"create view {table} as select * from '/root/testdata/{sf}/{table}.parquet'")
    want = duck.sql(ORACLE_SQL[name])
    got = QUERIES[name](llm, f"/root/testdata/{sf}")
    order = sorted(want.columns)
    assert sorted(got.columns) == order
    expected = sorted(want.select(", ".join(order)).fetchall())
    assert len(expected) > 20
    assert sorted(map(tuple, got.select(order).collect())) == expected

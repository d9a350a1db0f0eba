import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.operators import latest_per_key

ROWS = [(1, 1, "a"), (1, None, "b"), (None, 1, "c"), (None, 2, "d")]


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_null_order(spark):
    df = spark.createDataFrame(ROWS, "k int, o int, v string")
    assert rows(latest_per_key(df, ["k"], ["o"])) == {(1, None, "b"), (None, 2, "d")}
    last = latest_per_key(df, ["k"], ["o"], nulls_first=False)
    assert rows(last) == {(1, 1, "a"), (None, 2, "d")}


def test_sort_expressions_and_several_columns(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (1, 2, "c")], "k int, o int, v string")
    assert rows(latest_per_key(df, ["k"], ["o", "v"])) == {(1, 2, "c")}
    assert rows(latest_per_key(df, ["k"], [F.col("o").asc()], ties=["v"])) == {(1, 1, "b")}
    assert rows(latest_per_key(df, ["k", "v"], ["o"])) == rows(df)


def test_needs_key_and_order(spark):
    df = spark.createDataFrame(ROWS, "k int, o int, v string")
    for key, order in (([], ["o"]), (["k"], [])):
        with pytest.raises(ValueError):
            latest_per_key(df, key, order)


def test_keeps_one_row_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS o")
    text = latest_per_key(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2


ints = st.one_of(st.none(), st.integers(0, 4))


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(data=st.lists(st.tuples(ints, ints, st.integers(0, 100)), max_size=40))
def test_against_brute_force(spark, data):
    df = spark.createDataFrame(data, "k int, o int, v int")
    best = {}
    for k, o, v in data:
        rank = (o is None, o or 0, v)
        best[k] = max(best.get(k, rank), rank)
    expected = {(k, None if is_null else o, v) for k, (is_null, o, v) in best.items()}
    result = latest_per_key(df, ["k"], ["o"], ties=["v"]).collect()
    assert {tuple(r) for r in result} == expected
    assert len(result) == len(best)


def test_names_with_dots(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], "k int, o int, `a.b` string")
    assert [tuple(r) for r in latest_per_key(df, ["k"], ["o"]).collect()] == [(1, 2, "y")]

"""Columns of any name go through, the names that operators use inside among them."""

import pytest

from tallyloom.operators import (
    Constraints,
    constraint_rules,
    count_outcomes,
    count_violations,
    latest_per_key,
    null_rules,
    tally,
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_latest_keeps_a_column_of_its_own_helper(spark):
    df = spark.createDataFrame([(1, 5, 9), (1, 6, 8)], ["k", "__n", "__n_"])
    assert rows(latest_per_key(df, ["k"], ["__n"])) == [(1, 6, 8)]
    assert latest_per_key(df, ["k"], ["__n"]).columns == df.columns


@pytest.mark.parametrize("limit", [0, 64 << 20])
@pytest.mark.parametrize("group", ["__key", "__copies", "a.b"])
def test_tally_groups_by_any_column(spark, limit, group):
    fact = spark.createDataFrame([(1, 5, "x"), (1, 5, "y"), (2, 6, "x"), (3, 7, "x")], ["id", group, "o"])
    dim = spark.createDataFrame([(1,), (1,), (2,)], ["id"])
    got = tally(fact, dim, "id", group, "o", {"__copies_": "x"}, "y", broadcast_bytes=limit)
    assert got.columns == [group, "__copies_", "total"]
    assert rows(got) == [(5, 2, 2), (6, 1, 1)]


@pytest.mark.parametrize("limit", [0, 64 << 20])
def test_tally_by_a_column_of_the_dimension(spark, limit):
    fact = spark.createDataFrame([(1, "x"), (2, "x")], ["__key", "o.p"])
    dim = spark.createDataFrame([(1, "g"), (1, "h"), (2, "g")], ["d.k", "__copies"])
    got = tally(fact, dim, ("__key", "d.k"), "__copies", "o.p", {"n": "x"}, broadcast_bytes=limit)
    assert rows(got) == [("g", 2), ("h", 1)]


def test_rules_over_names_with_dots(spark):
    df = spark.createDataFrame([("a", None), ("a", "long"), (None, "b")], ["k.1", "extra"])
    assert [(r["rule"], r["actual"]) for r in null_rules(df, "t", ["k.1", "extra"]).collect()] == [("k.1", 1), ("extra", 1)]
    rules = Constraints(not_null=("k.1",), max_length={"extra": 2}, key=("k.1",))
    found = {r["rule"]: r["actual"] for r in constraint_rules(df, "t", rules).collect()}
    assert found == {"null_k.1": 1, "long_extra": 1, "extra_keys": 1}
    assert count_violations(df, rules).columns == ["null_k.1", "long_extra", "extra_keys"]
    assert rows(latest_per_key(df, ["k.1"], ["extra"])) == [("a", None), (None, "b")]
    assert rows(count_outcomes(df, "k.1", "extra", {"none": None})) == [("a", 1), (None, 0)]

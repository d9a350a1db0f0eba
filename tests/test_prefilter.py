"""The Bloom filter of a dimension's keys: what it keeps, and that no result depends on it."""

import pytest

from tallyloom.operators import KeyFilter, tally

OUTCOMES = {"outcome": "medal", "outcomes": {"gold": "G"}, "not_value": "N"}


def as_set(df):
    return {tuple(row) for row in df.collect()}


def test_keeps_every_key_and_few_others(spark):
    filter_ = KeyFilter(spark.range(0, 300_000, 10).toDF("k"), "k")
    left = filter_.keep(spark.range(300_000).toDF("id"), "id")
    assert left.columns == ["id"]
    assert left.where("id % 10 = 0").count() == 30_000
    assert left.count() < 30_000 + 0.02 * 270_000
    assert filter_.table().count() == filter_.n_rows


@pytest.mark.parametrize("kind", ["string", "int", "bigint", "date", "timestamp", "double", "decimal(9,2)"])
def test_every_type_of_key(spark, kind):
    cast = f"cast(date_add('2020-01-01', cast(id as int)) as {kind})" if kind in ("date", "timestamp") else f"cast(id as {kind})"
    fact = spark.range(500).selectExpr(f"if(id % 9 = 0, null, {cast}) as noc", "id % 4 as sport", "if(id % 3 = 0, 'N', 'G') as medal")
    dim = spark.range(0, 2000, 7).selectExpr(f"if(id % 5 = 0, null, {cast}) as noc").unionAll(spark.range(7, 8).selectExpr(f"{cast} as noc"))
    plain = tally(fact, dim, on="noc", group="sport", **OUTCOMES)
    for given in (dim, dim.selectExpr("cast(noc as string) as noc")):
        got = tally(fact, given, on="noc", group="sport", **OUTCOMES, broadcast_bytes=0, prefilter=True)
        want = plain if given is dim else tally(fact, given, on="noc", group="sport", **OUTCOMES)
        assert as_set(got) == as_set(want)


def test_empty_tables_and_clashing_names(spark):
    fact = spark.range(9).selectExpr("id as `__row`", "id as `__words`", "id % 2 as sport", "'G' as medal")
    dim = spark.range(3).selectExpr("id as noc")
    on = ("__row", "noc")
    got = tally(fact, dim, on=on, group="sport", **OUTCOMES, broadcast_bytes=0, prefilter=True)
    assert as_set(got) == {(0, 2, 2), (1, 1, 1)}
    assert KeyFilter(dim, "noc").keep(fact, "__words").columns == fact.columns
    none = dim.limit(0)
    assert tally(fact, none, on=on, group="sport", **OUTCOMES, broadcast_bytes=0, prefilter=True).collect() == []
    assert KeyFilter(dim, "noc").keep(fact.limit(0), "__row").collect() == []


def test_a_filter_beyond_its_bytes_is_not_used(spark):
    big = KeyFilter(spark.range(100_000).toDF("k"), "k", max_bytes=1 << 10)
    assert not big.fits
    rows = spark.range(5).toDF("k")
    assert big.keep(rows, "k") is rows


def test_filter_stands_under_the_first_aggregate(spark):
    fact = spark.range(1000).selectExpr("id as noc", "id % 4 as sport", "'G' as medal")
    dim = spark.range(0, 1000, 10).toDF("noc")
    plan = tally(fact, dim, on="noc", group="sport", **OUTCOMES, broadcast_bytes=0, prefilter=True)
    text = plan._jdf.queryExecution().executedPlan().toString()
    lines = text.splitlines()
    partial = next(i for i, line in enumerate(lines) if "HashAggregate" in line and "partial_count" in line and "sport" in line)
    below = lines[partial + 1 : partial + 4]
    assert any("BroadcastHashJoin" in line for line in below), text
    assert not any("Exchange hashpartitioning" in line for line in below)

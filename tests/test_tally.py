"""The tally's golden cases, its three ways to join, and its plans."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyloom.operators import count_outcomes, tally
from tallyloom.plans import MEDALS
from tallyloom.sources import name_for_sql, read_csv

FACT_A = """sport,noc,medal
Judo,KOR,Gold
Judo,KOR,Gold
Judo,KOR,NA
Judo,KOR,
Judo,KOR,Other
Golf,USA,Gold
Archery,KOR,NA
,KOR,Bronze
Rugby,ZZZ,Gold
Rugby,,Gold
"""
FACT_B = """sport,noc,medal
Judo, KOR , Gold 
Judo,KOR, Silver 
Judo,KOR,Bronze
"""
ONE = "noc\nKOR\nUSA\n"
DUP = "noc\nKOR\nKOR\nUSA\n"

SQL = """
SELECT sport,
       count(CASE WHEN medal = 'Gold' THEN 1 END) AS gold,
       count(CASE WHEN medal = 'Silver' THEN 1 END) AS silver,
       count(CASE WHEN medal = 'Bronze' THEN 1 END) AS bronze,
       count(CASE WHEN medal <> 'NA' THEN 1 END) AS total
FROM golden_fact f JOIN golden_dim d ON d.noc = f.noc {where}
GROUP BY 1
"""


def rows(df):
    return {tuple(r) for r in df.collect()}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "fact, dim, trim, expected",
    [
        (FACT_A, ONE, None, {("Judo", 2, 0, 0, 3), ("Archery", 0, 0, 0, 0), (None, 0, 0, 1, 1)}),
        (FACT_A, DUP, None, {("Judo", 4, 0, 0, 6), ("Archery", 0, 0, 0, 0), (None, 0, 0, 2, 2)}),
        (FACT_B, ONE, False, {("Judo", 0, 0, 1, 2)}),
        (FACT_B, ONE, True, {("Judo", 1, 1, 1, 3)}),
        (FACT_B, DUP, False, {("Judo", 0, 0, 2, 4)}),
        (FACT_B, DUP, True, {("Judo", 2, 2, 2, 6)}),
    ],
)
def test_golden(spark, csv_file, fact, dim, trim, expected):
    fact, dim = csv_file("fact.csv", fact), csv_file("dim.csv", dim)
    for trimmed in (True, False) if trim is None else (trim,):
        for infer in (True, False):
            frames = [read_csv(spark, p, infer=infer, trim=trimmed) for p in (fact, dim)]
            assert rows(tally(*frames, **MEDALS)) == expected
            name_for_sql({"golden_fact": frames[0], "golden_dim": frames[1]})
            assert rows(spark.sql(SQL.format(where="WHERE d.noc = 'KOR'"))) == expected


values = st.sampled_from([None, "a", "b", "c"])


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    fact=st.lists(
        st.tuples(values, values, st.sampled_from([None, "Gold", "Silver", "Bronze", "NA", "x"])),
        max_size=30,
    ),
    dim=st.lists(values, max_size=6),
)
def test_every_way_equals_the_plain_join(spark, fact, dim):
    fact = spark.createDataFrame(fact, "sport string, noc string, medal string")
    dim = spark.createDataFrame([(d,) for d in dim], "noc string")
    name_for_sql({"golden_fact": fact, "golden_dim": dim})
    spec = {k: v for k, v in MEDALS.items() if k != "key_value"}
    expected = sorted(spark.sql(SQL.format(where="")).collect(), key=str)
    broadcast = tally(fact, dim, **spec)
    shuffled = tally(fact, dim, **spec, broadcast_bytes=0)
    assert sorted(broadcast.collect(), key=str) == expected
    assert sorted(shuffled.collect(), key=str) == expected
    assert all(r.total >= r.gold + r.silver + r.bronze for r in expected)


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_group_of_the_dimension(spark, limit):
    fact = spark.createDataFrame(
        [(1, "Gold"), (1, None), (2, "Gold"), (3, "Gold")], "id int, medal string"
    )
    dim = spark.createDataFrame(
        [(1, "x"), (1, "y"), (1, "y"), (2, "x"), (None, "z")], "id int, sport string"
    )
    counts = {"gold": "Gold", "none": None}
    result = tally(fact, dim, "id", "sport", "medal", counts, broadcast_bytes=limit)
    assert rows(result) == {("x", 2, 1), ("y", 2, 2)}
    one = tally(fact, dim, "id", "sport", "medal", counts, key_value=2, broadcast_bytes=limit)
    assert rows(one) == {("x", 1, 0)}


def test_shuffled_join_of_a_hot_key(spark):
    """A key with a third of all rows meets a dimension that may not be broadcast."""
    fact = spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS noc",
        "id % 100 AS sport",
        "CASE WHEN id % 2 = 0 THEN 'Gold' ELSE 'NA' END AS medal",
    )
    dim = spark.range(20_000).selectExpr("id AS noc").unionAll(spark.range(1).toDF("noc"))
    spec = {k: v for k, v in MEDALS.items() if k != "key_value"}
    expected = rows(tally(fact, dim, **spec))
    result = tally(fact, dim, **spec, broadcast_bytes=0)
    # The fact is read once and counted before its shuffle.
    assert plan(result).count("Range (0, 30000") == plan(result).count("SortMergeJoin") == 1
    assert "Broadcast" not in plan(result)
    assert rows(result) == expected
    # 10,000 rows of the hot key count twice.
    assert sum(r[1] for r in expected) == 5_000 * 2 + sum(
        1 for i in range(20_000) if i % 3 and i % 2 == 0
    )


def test_hot_dimension_key_with_many_groups(spark):
    """A third of the dimension's rows share a key, and so do a third of the fact's."""
    fact = spark.range(3_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS noc",
        "CASE WHEN id % 2 = 0 THEN 'Gold' ELSE 'NA' END AS medal",
    )
    dim = spark.range(9_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS noc", "id % 50 AS sport"
    )
    spec = {k: v for k, v in MEDALS.items() if k != "key_value"}
    name_for_sql({"golden_fact": fact, "golden_dim": dim})
    expected = rows(spark.sql(SQL.format(where="")))
    for limit in (64 << 20, 0):
        assert rows(tally(fact, dim, **spec, broadcast_bytes=limit)) == expected


KEYS = {
    "string": ["'07'", "'7'", "'8'", "'0'", "NULL"],
    "int": ["7", "8", "0", "NULL"],
    "bigint": ["7", "8", "0", "NULL"],
    "double": ["7.0", "8.0", "-0.0", "0.0", "double('NaN')", "NULL"],
    "date": ["DATE '2020-01-07'", "DATE '2020-01-08'", "NULL"],
    "day": ["'2020-01-07'", "'2020-01-08'", "NULL"],
}


@pytest.mark.parametrize(
    "fact_kind, dim_kind",
    [("string", "int"), ("int", "string"), ("int", "bigint"), ("double", "int"),
     ("double", "double"), ("date", "day"), ("day", "date"), ("string", "string")],
)
@pytest.mark.parametrize("group_of", ["fact", "dim"])
def test_all_ways_agree_on_keys_of_any_types(spark, fact_kind, dim_kind, group_of):
    def keys(kind, extra):
        values = ", ".join(f"({k}, {i})" for i, k in enumerate(KEYS[kind]))
        return spark.sql(f"SELECT noc, {extra} FROM VALUES {values} AS t(noc, i), (SELECT explode(sequence(1, 5)) AS c)")

    sport = "concat('s', i % 2) AS sport"
    medal = "CASE WHEN c % 2 = 0 THEN 'Gold' ELSE 'NA' END AS medal"
    fact = keys(fact_kind, f"{medal}, {sport}" if group_of == "fact" else medal)
    dim = keys(dim_kind, sport if group_of == "dim" else "i")
    spec = {k: v for k, v in MEDALS.items() if k != "key_value"}
    name_for_sql({"golden_fact": fact, "golden_dim": dim})
    expected = rows(spark.sql(SQL.format(where="")))
    assert expected
    for limit in (64 << 20, 0):
        assert rows(tally(fact, dim, **spec, broadcast_bytes=limit)) == expected


def test_plan_filters_both_scans_and_broadcasts(spark, tmp_path):
    spark.range(100).selectExpr(
        "'s' AS sport", "cast(id % 5 AS string) AS noc", "'Gold' AS medal", "id AS other"
    ).write.parquet(str(tmp_path / "fact"))
    spark.range(5).selectExpr("cast(id AS string) AS noc", "id AS region").write.parquet(
        str(tmp_path / "dim")
    )
    fact, dim = (spark.read.parquet(str(tmp_path / n)) for n in ("fact", "dim"))
    text = plan(tally(fact, dim, **{**MEDALS, "key_value": "3"}))
    assert "BroadcastHashJoin" in text
    assert text.count("EqualTo(noc,3)") == 2
    assert "other" not in text and "region" not in text


def test_count_outcomes_without_a_total(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2)], "g string, v int")
    result = count_outcomes(df, "g", "v", {"ones": 1, "none": None})
    assert rows(result) == {("a", 1, 1), (None, 0, 0)}

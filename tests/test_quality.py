import pytest

from tallyloom.operators import (
    Constraints,
    QualityError,
    constraint_rules,
    count_violations,
    first_cell_rule,
    null_rules,
    require,
    row_count_rules,
    scalar_rule,
)


def test_row_count(spark):
    empty, full = spark.range(0), spark.range(3)
    rules = row_count_rules({"empty": empty, "full": full})
    assert {tuple(r) for r in rules.collect()} == {("empty", 0, True), ("full", 3, True)}
    require(rules)
    with pytest.raises(QualityError, match="table_name=empty, row_count=0"):
        require(row_count_rules({"empty": empty, "full": full}, min_rows=1))


def test_null_rules(spark):
    df = spark.createDataFrame([("a", None), (None, None)], "x string, y string")
    rules = null_rules(df, "t", ["x", "y"])
    assert {tuple(r) for r in rules.collect()} == {
        ("t", "x", 1, 0, False),
        ("t", "y", 2, 0, False),
    }
    with pytest.raises(ValueError, match="rule=x, actual=1, expected=0"):
        require(rules)
    require(null_rules(df.where("x IS NOT NULL"), "t", ["x"]))
    require(null_rules(df, "t", ["y"], expected=2))


def test_scalar_rule(spark):
    spark.range(4).createOrReplaceTempView("four")
    require(scalar_rule(spark, "four", "SELECT count(*) FROM four", 4))
    require(scalar_rule(spark, "four", "SELECT 'a', id FROM four", "a"))
    with pytest.raises(QualityError, match="actual=4, expected=0"):
        require(scalar_rule(spark, "four", "SELECT count(*) FROM four", 0))
    with pytest.raises(QualityError):
        require(scalar_rule(spark, "four", "SELECT id FROM four WHERE id > 9", 0))
    require(scalar_rule(spark, "four", "SELECT id FROM four WHERE id > 9", None))
    require(first_cell_rule(spark.range(1), "one", "its id", 0))


def test_constraints(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 2), ("x" * 256, None), (None, 3)], "sport string, total int"
    )
    checks = Constraints(not_null=("sport", "total"), max_length={"sport": 255}, key=("sport",))
    counts = count_violations(df, checks).first().asDict()
    assert counts == {"null_sport": 1, "null_total": 1, "long_sport": 1, "extra_keys": 1}
    rules = constraint_rules(df, "t", checks)
    assert rules.where("NOT passed").count() == 4
    with pytest.raises(QualityError):
        require(rules)
    require(constraint_rules(df.limit(1), "t", checks))
    require(constraint_rules(df.limit(0), "t", checks))


def test_constraints_without_a_key_need_no_shuffle_by_key(spark):
    df = spark.range(10).selectExpr("cast(id AS string) AS s")
    counts = count_violations(df, Constraints(not_null=("s",), max_length={"s": 0}))
    assert counts.first().asDict() == {"null_s": 0, "long_s": 10}
    with pytest.raises(ValueError, match="no constraint"):
        constraint_rules(df, "t", Constraints())
    assert "hashpartitioning" not in counts._jdf.queryExecution().executedPlan().toString()


def test_several_key_columns(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (1, 2)], "a int, b int")
    assert count_violations(df, Constraints(key=("a", "b"))).first().extra_keys == 2
    assert count_violations(df, Constraints(key=("a",))).first().extra_keys == 3

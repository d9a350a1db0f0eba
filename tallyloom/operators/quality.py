"""Quality rules as rows, and the gate that stops a job on a failed rule."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.names import column_of, quoted


class QualityError(ValueError):
    """A quality rule or constraint failed."""


def row_count_rules(tables: Mapping[str, DataFrame], min_rows: int = 0) -> DataFrame:
    """One row ``(table_name, row_count, passed)`` per table."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"),
            "row_count",
            (F.col("row_count") >= min_rows).alias("passed"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def null_rules(
    df: DataFrame, table_name: str, columns: Sequence[str], expected: int = 0
) -> DataFrame:
    """One row ``(table_name, rule, actual, expected, passed)`` per column.

    ``actual`` is the column's number of NULLs and ``rule`` the column's name.
    All columns are counted in one pass.
    """
    counts = df.agg(*[F.count(F.when(column_of(df, c).isNull(), 1)).alias(c) for c in columns])
    return as_rules(counts, table_name, expected)


def scalar_rule(spark: SparkSession, table_name: str, check_sql: str, expected: Any) -> DataFrame:
    """Run ``check_sql`` and compare its first cell to ``expected``; one rule row."""
    return first_cell_rule(spark.sql(check_sql), table_name, check_sql, expected)


def first_cell_rule(result: DataFrame, table_name: str, rule: str, expected: Any) -> DataFrame:
    """:func:`scalar_rule` for a result from elsewhere, such as ``read_jdbc(query=...)``.

    A result without rows gives a NULL and fails, unless NULL is expected.
    """
    first_cell = result.select(F.col(quoted(result.columns[0])).alias("actual")).limit(1)
    actual_type = first_cell.schema["actual"].dataType
    return first_cell.agg(F.max("actual").alias("actual")).select(
        F.lit(table_name).alias("table_name"),
        F.lit(rule).alias("rule"),
        "actual",
        F.lit(expected).cast(actual_type).alias("expected"),
        F.col("actual").eqNullSafe(F.lit(expected)).alias("passed"),
    )


def require(rules: DataFrame) -> None:
    """Raise :class:`QualityError` naming every rule row that did not pass."""
    failed = rules.where(~F.coalesce(F.col("passed"), F.lit(False))).collect()
    if failed:
        lines = [", ".join(f"{k}={v}" for k, v in row.asDict().items()) for row in failed]
        raise QualityError("data quality check failed: " + "; ".join(lines))


def require_observed(table_name: str, checks: Sequence[tuple[str, int, bool]]) -> None:
    """Raise :class:`QualityError` naming each (rule, actual, passed) that did not pass."""
    told = {rule: f"rule={rule}, actual={n}" for rule, n, _ in checks} | {
        "row_count": "".join(f"row_count={n}" for rule, n, _ in checks if rule == "row_count")
    }
    failed = [f"table_name={table_name}, {told[rule]}, passed=False" for rule, _, ok in checks if not ok]
    if failed:
        raise QualityError("data quality check failed: " + "; ".join(failed))


def as_rules(counts: DataFrame, table_name: str, expected: int = 0) -> DataFrame:
    """Turn a one-row DataFrame of counts into one rule row per column."""
    return counts.unpivot([], [quoted(c) for c in counts.columns], "rule", "actual").select(
        F.lit(table_name).alias("table_name"),
        "rule",
        "actual",
        F.lit(expected).cast("bigint").alias("expected"),
        (F.col("actual") == expected).alias("passed"),
    )

"""Whole jobs: the daily refresh, the local extract and the two-table load."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tallyloom.operators import Constraints, tally
from tallyloom.plans.bulk import load
from tallyloom.plans.loads import Rules, create_schema, create_table, replace_table
from tallyloom.sinks import land_raw, replace_jdbc, write_csv
from tallyloom.sources import JdbcDatabase, read_csv

# Fixed values of the medal tally and its result table.
MEDALS = {
    "on": "noc",
    "key_value": "KOR",
    "group": "sport",
    "outcome": "medal",
    "outcomes": {"gold": "Gold", "silver": "Silver", "bronze": "Bronze"},
    "not_value": "NA",
    "total": "total",
}
MEDAL_COLUMNS = {
    "sport": "VARCHAR(255)",
    "gold": "BIGINT NOT NULL",
    "silver": "BIGINT NOT NULL",
    "bronze": "BIGINT NOT NULL",
    "total": "BIGINT NOT NULL",
}
MEDAL_CONSTRAINTS = Constraints(
    not_null=("sport", "gold", "silver", "bronze", "total"),
    max_length={"sport": 255},
    key=("sport",),
)


def refresh(
    spark: SparkSession,
    incoming: str | Sequence[str],
    raw: str,
    fact_path: str,
    dim_path: str,
    table: str,
    spec: Mapping[str, object] = MEDALS,
    columns: Mapping[str, str] = MEDAL_COLUMNS,
    constraints: Constraints = MEDAL_CONSTRAINTS,
    key: str | None = "sport",
    buckets: int = 8,
    min_rows: int = 0,
    rules: Rules = (),
    predicates: Mapping[str, str] | None = None,
    schema_location: str | None = None,
    database: JdbcDatabase | None = None,
) -> DataFrame:
    """Land the incoming CSV files, tally them, and publish the gated result.

    ``fact_path`` and ``dim_path`` lie in the ``incoming`` folders, whose CSV files
    are all landed under ``raw``. The result replaces the rows of ``table`` only after it passed
    the constraints, ``rules`` and ``predicates`` of ``replace_table``, so a second run, or a failed
    one, leaves no duplicates. A table of other columns is refused and left as it is.
    With ``database`` the published rows also replace the table of that name there.
    """
    land_raw(spark, incoming, raw)
    create_schema(spark, table.rpartition(".")[0] or "default", schema_location)
    create_table(spark, table, columns, key=key, buckets=buckets)
    result = tally(read_csv(spark, fact_path), read_csv(spark, dim_path), **spec)
    replace_table(result, table, constraints, min_rows, rules=rules, predicates=predicates)
    published = spark.table(table)
    if database is not None:
        replace_jdbc(published, database, table)
    return published


def local_extract(
    spark: SparkSession,
    fact_path: str,
    dim_path: str,
    result_path: str,
    spec: Mapping[str, object] = MEDALS,
    fact_schema: str | None = None,
    dim_schema: str | None = None,
    single_file: bool = False,
) -> DataFrame:
    """Tally trimmed CSV files into a CSV, of one file if asked; returns it as read back.

    Without a schema the column types are inferred, which reads the files twice.
    """
    fact = read_csv(spark, fact_path, schema=fact_schema, infer=True, trim=True)
    dim = read_csv(spark, dim_path, schema=dim_schema, infer=True, trim=True)
    result = tally(fact, dim, **spec)
    write_csv(result, result_path, single_file=single_file)
    return read_csv(spark, result_path, schema=result.schema)


def load_fact_and_dimension(
    spark: SparkSession,
    fact: tuple[str, str | Sequence[str]],
    dim: tuple[str, str | Sequence[str]],
    options: Mapping[str, object] | None = None,
) -> None:
    """Replace the rows of two tables, fact first; each pair is (table, paths)."""
    for table, paths in (fact, dim):
        load(spark, table, paths, mode="truncate", options=options)

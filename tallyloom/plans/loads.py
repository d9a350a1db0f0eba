"""Tables: definitions, appends, and the gated replacement of a table's rows."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators import (
    Constraints,
    constraint_rules,
    observed_metrics,
    require,
    require_observed,
    scalar_rule,
)
from tallyloom.operators.names import quoted
from tallyloom.plans.versions import check_version, held, table_version
from tallyloom.sinks.layout import co_locate
from tallyloom.sources.catalog import table_columns, table_details

Rules = Sequence[tuple[str, object]]


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a schema if it is missing."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{where}")


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop a table if it is there."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def create_table(
    spark: SparkSession,
    table: str,
    columns: Mapping[str, str],
    key: str | None = None,
    buckets: int | None = None,
) -> None:
    """Create a Parquet table if it is missing.

    ``columns`` maps each name to its SQL type, such as ``VARCHAR(255)``, whose
    length Spark enforces on every write. ``key`` distributes the rows over
    ``buckets``, by default as many as a shuffle has partitions, so that joins and
    aggregates on it need no shuffle. Choose a column that identifies the rows:
    one task reads a bucket, and a hot value would make a hot bucket.
    """
    listed = ", ".join(f"`{name}` {sql_type}" for name, sql_type in columns.items())
    clustered = ""
    if key:
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        clustered = f" CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({listed}) USING parquet{clustered}")


def create_table_as(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """Create a table from a DataFrame, partitioned by columns that then come last."""
    rows = df.hint("rebalance", *map(quoted, partition_by)) if partition_by else df
    rows.write.format("parquet").partitionBy(*partition_by).saveAsTable(table)


def insert_into(
    df: DataFrame,
    table: str,
    clustered: bool = False,
    observation: Observation | None = None,
    metrics: Sequence[Column] = (),
) -> None:
    """Append a DataFrame's rows, matching columns by name; bucketed tables get few files.

    The columns must be those of the table, in any order: one that either side lacks
    is refused before anything is written. A bucketed or partitioned table's rows are shuffled by its
    key first, unless ``clustered`` says that rows of one key lie together already, as
    after an aggregate or a window by that key. ``metrics`` are taken into ``observation`` as the rows are written.
    """
    spark = df.sparkSession
    columns = table_columns(spark, table)
    given, wanted = ({c.lower() for c in names} for names in (df.columns, columns))
    if given != wanted or len(df.columns) != len(columns):
        differ = ", ".join(sorted(given ^ wanted)) or "a column twice"
        raise ValueError(f"the rows and {table} differ in columns: {differ}")
    rows = df.select(*[F.col(quoted(c)) for c in columns])
    details = table_details(spark, table)
    if clustered:
        pass
    elif details.partitioned_by:
        rows = rows.hint("rebalance", *map(quoted, details.partitioned_by))
    elif len(details.bucketed_by) == 1:
        rows = co_locate(rows, details.bucketed_by[0], details.buckets)
    if observation is not None:
        # After the shuffle, in the stage that writes: each row counts once, whatever is run again.
        rows = rows.observe(observation, *metrics)
    rows.write.insertInto(table)


def truncate_table(spark: SparkSession, table: str) -> None:
    """Delete every row."""
    spark.sql(f"TRUNCATE TABLE {table}")


def replace_table(
    df: DataFrame,
    table: str,
    constraints: Constraints | None = None,
    min_rows: int = 0,
    keep_old: bool = False,
    rules: Rules = (),
    predicates: Mapping[str, str] | None = None,
    since: str | None = None,
    clustered: bool = False,
) -> None:
    """Replace the rows of ``table`` with those of ``df``, which may read ``table``.

    The rows are written beside the table and checked there; a failed check raises
    and leaves the table as it was. ``rules`` are (SQL, expected) pairs, whose SQL
    names the table to check as ``{table}`` and whose first cell must be as expected.
    ``predicates`` are named SQL conditions that every row must meet; like row count, NULLs and
    lengths they are counted while the rows are written, so only keys and ``rules`` read
    the files again. Then the table is pointed at the new files in
    one catalog change, so readers see the old rows or the new ones and no data is
    moved. The old files go afterwards, unless ``keep_old`` leaves them to readers
    that are still running.

    Rows that another job appends, or a replacement it makes, stop this one instead of being
    lost: the table's files must be those of ``since``, which ``table_version`` gave before
    ``df`` was made, or else those at the call. From that check to the catalog change, some milliseconds, a
    marker holds off other replacements, and what is left open is an append that is published just
    then by a writer that does not ask for the marker.

    A partitioned table is replaced by :func:`tallyloom.plans.replace_partitions`; it is refused here,
    as its partitions carry locations of their own, and so is an external one, whose location is not ours to change.
    """
    spark = df.sparkSession
    details = table_details(spark, table)
    if details.partitioned_by:
        raise ValueError(f"{table} is partitioned; replace_table needs an unpartitioned table")
    if details.kind != "MANAGED":
        raise ValueError(f"{table} is external; replace_table needs a managed table")
    old = details.location
    since = since or table_version(spark, table, old)
    stage, new = _stage(spark, table)
    try:
        checks = _write_observed(df, stage, table, constraints, min_rows, predicates, clustered)
        _gate(spark, stage, table, constraints, rules, checks)
        with held(spark, old, table):
            if _location(spark, table) != old:
                raise RuntimeError(f"{table} was replaced by another job in the meantime")
            check_version(spark, table, old, since)
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{new}'")
    except BaseException:
        # A catalog may report an error for a change it made: never drop live files.
        if _location(spark, table) != new:
            _drop_with_files(spark, stage, new)
        raise
    spark.catalog.refreshTable(table)
    # The stage has a location of its own, so dropping it leaves the files.
    drop_table(spark, stage)
    if not keep_old:
        _drop_with_files(spark, f"{stage}_old", old, like=table)


def _write_observed(
    df: DataFrame,
    stage: str,
    table: str,
    constraints: Constraints | None,
    min_rows: int,
    predicates: Mapping[str, str] | None,
    clustered: bool = False,
) -> list[tuple[str, int, bool]]:
    """Write into ``stage``; what was counted on the way, as (rule, actual, passed)."""
    metrics = observed_metrics(df, constraints, predicates or {})
    if not min_rows and len(metrics) == 1:
        insert_into(df, stage, clustered)
        return []
    observation = Observation()
    insert_into(df, stage, clustered, observation, list(metrics.values()))
    found = observation.get
    return [
        (rule, found.get(f"m{k}", 0), found.get(f"m{k}", 0) >= min_rows if k == 0 else not found.get(f"m{k}", 0))
        for k, rule in enumerate(metrics)
    ]


def _gate(spark, stage, table, constraints, rules, checks) -> None:
    """Check the rows that were written, not the plan that made them."""
    require_observed(table, checks)
    if constraints and constraints.key:
        require(constraint_rules(spark.table(stage), table, Constraints(key=constraints.key)))
    if rules:
        checked = [scalar_rule(spark, table, sql.replace("{table}", stage), e) for sql, e in rules]
        for rule in checked:
            require(rule)


def _location(spark: SparkSession, table: str) -> str:
    return table_details(spark, table).location


def _stage(spark: SparkSession, table: str, inside: bool = False) -> tuple[str, str]:
    """A table like ``table`` whose files lie in a new folder beside it, or in its own."""
    unique = uuid.uuid4().hex
    own = _location(spark, table).rstrip("/")
    folder = f"{own}/staged-{unique}"
    if not inside:
        folder = f"{own.rpartition('/')[0]}/{table.rpartition('.')[2]}__{unique}"
    stage = f"{table}__{unique}"
    spark.sql(f"CREATE TABLE {stage} LIKE {table} LOCATION '{folder}'")
    return stage, _location(spark, stage)


def _drop_with_files(spark: SparkSession, table: str, location: str, like: str = "") -> None:
    """Remove ``location`` through a managed table, whose drop takes its files along."""
    holder = f"{table}_drop"
    # The second round removes the empty folder that the holder was created with.
    for folder in (location, None):
        spark.sql(f"CREATE TABLE {holder} LIKE {like or table}")
        if folder:
            spark.sql(f"ALTER TABLE {holder} SET LOCATION '{folder}'")
        drop_table(spark, holder)
    if not like:
        drop_table(spark, table)

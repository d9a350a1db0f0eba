"""Partitioned tables: replaced partition by partition, and merged by key where the batch touches them."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators import Constraints, latest_per_key
from tallyloom.operators.names import column_of, quoted
from tallyloom.plans import loads
from tallyloom.plans.versions import check_version, held, table_version
from tallyloom.sources.catalog import table_details

_KEY, _PARTS, _COLUMN = "tallyloom.key", "tallyloom.parts", "tallyloom.column"
_NULL = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class TableKey:
    """How a keyed table deals its rows to partitions."""

    key: tuple[str, ...]
    parts: int
    column: str

    def place(self, df: DataFrame) -> DataFrame:
        """``df`` with the partition of each row. NULL keys have one, too."""
        part = F.pmod(F.xxhash64(*[column_of(df, c) for c in self.key]), F.lit(self.parts))
        return df.withColumn(self.column, part.cast("int"))


def create_keyed_table(
    spark: SparkSession,
    table: str,
    columns: Mapping[str, str],
    key: Sequence[str],
    parts: int = 64,
    column: str = "key_part",
) -> None:
    """Create a Parquet table whose rows lie in ``parts`` partitions by a hash of ``key``.

    ``column`` is the partition column that this adds. A load by key then reads and writes the
    partitions of the batch's keys only. Choose ``parts`` so that a partition is some tasks' work: a
    batch of scattered keys touches all of them.
    """
    names = {c.lower() for c in columns}
    if missing := [c for c in key if c.lower() not in names]:
        raise ValueError(f"{table} would have no column {', '.join(missing)}")
    if column.lower() in names:
        raise ValueError(f"{table} has a column {column} already")
    listed = ", ".join(f"{quoted(name)} {sql_type}" for name, sql_type in columns.items())
    told = {_KEY: json.dumps(list(key)), _PARTS: str(parts), _COLUMN: column}
    properties = ", ".join(f"'{k}' = {_literal(v)}" for k, v in told.items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({listed}, {quoted(column)} INT) USING parquet "
        f"PARTITIONED BY ({quoted(column)}) TBLPROPERTIES ({properties})"
    )


def table_key(spark: SparkSession, table: str) -> TableKey | None:
    """The key of a table of :func:`create_keyed_table`; None for any other."""
    told = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    if _KEY not in told:
        return None
    return TableKey(tuple(json.loads(told[_KEY])), int(told[_PARTS]), told[_COLUMN])


def merge_latest(
    batch: DataFrame,
    table: str,
    order: Sequence[str | Column],
    ties: Sequence[str | Column] = (),
    constraints: Constraints | None = None,
    min_rows: int = 0,
    rules: loads.Rules = (),
    predicates: Mapping[str, str] | None = None,
    keep_old: bool = False,
    since: str | None = None,
) -> list[int]:
    """Add rows to a keyed table and keep the latest of each key; returns the partitions written.

    The same rows result as from a whole ``keep_latest`` load, as long as the other partitions hold each key once:
    partitions that the batch has no key of are neither read nor written. Each partition that it has is
    collapsed whole, old duplicates included. The numbers of partitions are all that
    reaches the driver.
    """
    spark = batch.sparkSession
    keyed = table_key(spark, table)
    if keyed is None:
        raise ValueError(f"{table} was not made by create_keyed_table")
    since = since or table_version(spark, table)
    placed = keyed.place(batch)
    part = F.col(quoted(keyed.column))
    touched = sorted(row[0] for row in placed.select(part).distinct().collect())
    if not touched:
        return []
    # Literals, so that the catalog hands the scan these partitions alone.
    old = spark.table(table).where(part.isin(touched))
    rows = latest_per_key(old.unionByName(placed), keyed.key, order, ties)
    replace_partitions(
        rows, table, constraints, min_rows, rules, predicates, keep_old=keep_old, since=since
    )
    return touched


def replace_partitions(
    df: DataFrame,
    table: str,
    constraints: Constraints | None = None,
    min_rows: int = 0,
    rules: loads.Rules = (),
    predicates: Mapping[str, str] | None = None,
    whole: bool = False,
    keep_old: bool = False,
    since: str | None = None,
) -> None:
    """Replace the partitions that ``df`` has rows of, all or none; with ``whole`` drop the others.

    The rows are written into a folder of their own within the table's and checked there; a failed check
    leaves every partition as it was. Then each partition is pointed at its new folder in the
    catalog, and new ones are added in one statement. An error on the way points those that were moved
    back to their old folders. No data is moved. A reader that plans its
    scan between two of these statements sees old and new partitions together; each
    partition is always whole.

    Gate and ``since`` are those of ``replace_table``. The table must be managed. The old folders
    go afterwards, unless ``keep_old`` leaves them to readers that are still running.
    """
    spark = df.sparkSession
    details = table_details(spark, table)
    if not details.partitioned_by:
        raise ValueError(f"{table} is not partitioned; use replace_table")
    if details.kind != "MANAGED":
        raise ValueError(f"{table} is external; replace_partitions needs a managed table")
    base = details.location
    since = since or table_version(spark, table, base)
    stage, new = loads._stage(spark, table, inside=True)
    moved: dict[str, str] = {}
    added: list[str] = []
    done = False
    try:
        checks = loads._write_observed(df, stage, table, constraints, min_rows, predicates)
        loads._gate(spark, stage, table, constraints, rules, checks)
        staged = _partitions(spark, stage)
        with held(spark, base, table):
            there = set(_partitions(spark, table))
            check_version(spark, table, base, since)
            try:
                for name in staged:
                    if name in there:
                        moved[name] = _partition_location(spark, table, name)
                        _point(spark, table, name, f"{new}/{name}")
                if added := [name for name in staged if name not in there]:
                    places = " ".join(f"{_spec(n)} LOCATION {_literal(f'{new}/{n}')}" for n in added)
                    spark.sql(f"ALTER TABLE {table} ADD {places}")
                if gone := sorted(there - set(staged)) if whole else []:
                    spark.sql(f"ALTER TABLE {table} DROP {', '.join(map(_spec, gone))}")
                done = True
            except BaseException:
                for name, old in moved.items():
                    _point(spark, table, name, old)
                if left := set(added) & set(_partitions(spark, table)):
                    spark.sql(f"ALTER TABLE {table} DROP {', '.join(map(_spec, sorted(left)))}")
                raise
    finally:
        # The stage has a location of its own, so dropping it leaves the files.
        loads.drop_table(spark, stage)
        if not done:
            _delete(spark, new)
        spark.catalog.refreshTable(table)
    if not keep_old:
        for folder in moved.values():
            _delete(spark, folder)
        # Earlier stages of which no partition is left.
        _delete_empty(spark, base)


def _partitions(spark: SparkSession, table: str) -> list[str]:
    return [row[0] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spec(name: str) -> str:
    """``PARTITION (...)`` for a name as the catalog shows it."""
    fields = []
    for part in name.split("/"):
        column, _, value = part.partition("=")
        value = "null" if value == _NULL else _literal(unquote(value))
        fields.append(f"{quoted(unquote(column))} = {value}")
    return f"PARTITION ({', '.join(fields)})"


def _point(spark: SparkSession, table: str, name: str, location: str) -> None:
    spark.sql(f"ALTER TABLE {table} {_spec(name)} SET LOCATION {_literal(location)}")


def _partition_location(spark: SparkSession, table: str, name: str) -> str:
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {_spec(name)}").collect()
    start = [row.col_name for row in details].index("# Detailed Partition Information")
    return next(r.data_type for r in details[start:] if r.col_name == "Location")


def _folder(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, name: str) -> None:
    path, files = _folder(spark, name)
    files.delete(path, True)


def _delete_empty(spark: SparkSession, base: str) -> None:
    path, files = _folder(spark, base)
    for status in files.listStatus(path):
        if status.getPath().getName().startswith("staged-"):
            inside = [s for s in files.listStatus(status.getPath()) if s.isDirectory()]
            if not inside:
                files.delete(status.getPath(), True)

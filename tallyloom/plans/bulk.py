"""Bulk loads of delimited files: append, truncate and load, load and keep the latest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyloom.operators import Constraints, latest_per_key
from tallyloom.operators.names import quoted
from tallyloom.plans import loads
from tallyloom.plans.partitions import merge_latest, replace_partitions, table_key
from tallyloom.plans.versions import table_version
from tallyloom.sources.catalog import table_details
from tallyloom.sources.csv import read_csv


def load(
    spark: SparkSession,
    table: str,
    paths: str | Sequence[str],
    mode: str = "append",
    columns: Sequence[str] | None = None,
    options: Mapping[str, object] | None = None,
    header: bool = True,
    key: Sequence[str] = (),
    order: Sequence[str | Column] = (),
    ties: Sequence[str | Column] = (),
    constraints: Constraints | None = None,
    min_rows: int = 0,
    rules: loads.Rules = (),
    predicates: Mapping[str, str] | None = None,
) -> None:
    """Load delimited files into an existing table.

    - ``append`` adds the rows,
    - ``truncate`` replaces the table's rows with them,
    - ``keep_latest`` adds them and keeps the latest row per ``key`` by ``order``
      over the whole table, whose old duplicates collapse too, so that loading a
      batch again changes nothing.

    Fields go by position to ``columns``, or to all of the table's columns, and
    unlisted columns are NULL. The first line of each file is skipped while
    ``header`` is on. ``options`` are reader options; a row that does not fit
    stops the load. ``constraints``, ``min_rows``, ``rules`` and ``predicates`` of
    :func:`replace_table` hold for the rows that the call writes: the batch in
    ``append``, the whole table in the other modes, of a keyed table the partitions that the batch touches.

    A partitioned table is replaced partition by partition, all or none. ``keep_latest`` on
    a table of :func:`tallyloom.plans.create_keyed_table` reads and writes only the
    partitions that the batch has keys of; ``key`` must then be the table's, or be left out.
    """
    if mode not in ("append", "truncate", "keep_latest"):
        raise ValueError(f"unknown load mode: {mode}")
    partitioned = bool(table_details(spark, table).partitioned_by)
    keyed = table_key(spark, table) if partitioned else None
    if mode == "keep_latest" and not ((key or keyed) and order):
        raise ValueError("keep_latest needs a key and an order")
    since = table_version(spark, table) if mode != "append" else None
    if keyed:
        batch = _read_batch(spark, table, paths, columns, header, options or {}, keyed.column)
        batch = keyed.place(batch)
    else:
        batch = _read_batch(spark, table, paths, columns, header, options or {})
    gate = {"constraints": constraints, "min_rows": min_rows, "rules": rules, "predicates": predicates}
    if mode == "append":
        if constraints or min_rows or rules or predicates:
            _append_checked(spark, batch, table, **gate)
        else:
            loads.insert_into(batch, table)
    elif mode == "keep_latest" and keyed:
        if key and tuple(map(str.lower, key)) != tuple(map(str.lower, keyed.key)):
            raise ValueError(f"the key of {table} is {', '.join(keyed.key)}")
        merge_latest(batch, table, order, ties, since=since, **gate)
    else:
        rows = batch
        if mode == "keep_latest":
            rows = latest_per_key(spark.table(table).unionByName(batch), key, order, ties)
        if partitioned:
            replace_partitions(rows, table, whole=True, since=since, **gate)
        else:
            loads.replace_table(rows, table, since=since, **gate)


def _read_batch(
    spark: SparkSession,
    table: str,
    paths: str | Sequence[str],
    columns: Sequence[str] | None,
    header: bool,
    options: Mapping[str, object],
    leave_out: str | None = None,
) -> DataFrame:
    fields = [field for field in spark.table(table).schema if field.name != leave_out]
    target = StructType(fields)
    by_name = {field.name.lower(): field for field in target}
    unknown = [c for c in columns or () if c.lower() not in by_name]
    if unknown:
        raise ValueError(f"{table} has no column {', '.join(unknown)}")
    listed = [by_name[c.lower()] for c in columns] if columns else list(target)
    batch = read_csv(
        spark, paths, schema=StructType(listed), header=header, strict=True, **options
    )
    given = {field.name for field in listed}
    return batch.select(
        *[
            F.col(quoted(f.name)) if f.name in given else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target
        ]
    )


def _append_checked(spark, batch, table, constraints, min_rows, rules, predicates) -> None:
    stage, new = loads._stage(spark, table)
    try:
        checks = loads._write_observed(batch, stage, table, constraints, min_rows, predicates)
        loads._gate(spark, stage, table, constraints, rules, checks)
        loads.insert_into(spark.table(stage), table)
    finally:
        loads._drop_with_files(spark, stage, new)

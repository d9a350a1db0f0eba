"""A tally that reads newly landed files only."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators import Constraints, count_per_key, tally_counts
from tallyloom.operators.names import free_name
from tallyloom.plans.jobs import MEDAL_COLUMNS, MEDAL_CONSTRAINTS, MEDALS
from tallyloom.plans.loads import Rules, create_schema, create_table, replace_table
from tallyloom.sinks import land_exact
from tallyloom.sources import current_files, landings, read_landing_csv


def tally_landed(
    spark: SparkSession,
    target: str,
    state: str,
    dim: DataFrame,
    columns: Sequence[str],
    on: str | tuple[str, str],
    group: str,
    outcome: str,
    outcomes: Mapping[str, Any],
    not_value: Any = None,
    total: str = "total",
    key_value: Any = None,
    broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """:func:`tallyloom.operators.tally` over the current files of ``target``, kept up to date.

    ``target`` is where ``land_exact`` landed the fact's CSV files, whose fields go by position to
    ``columns``. Under ``state`` stand the counts of each landing per file, key and group; a
    call counts the landings that are not there yet and reads no other. A file that a later
    landing replaced is taken off, since only counts of a file's current landing are
    summed. The dimension may change between calls: every key is counted, ``key_value`` or not.

    Counts are kept apart by what they count, so one ``state`` can serve several tallies. A call that
    dies leaves whole landings of counts or none, and the next one goes on from there.
    """
    fact_key = on if isinstance(on, str) else on[0]
    names = [*outcomes, *([] if not_value is None else [total])]
    by = list(dict.fromkeys([fact_key, *([group] if _in(group, columns) else [])]))
    what = [list(columns), by, outcome, dict(outcomes), not_value, total]
    place = f"{state.rstrip('/')}/{hashlib.sha256(json.dumps(what).encode()).hexdigest()[:16]}"
    _count_landings(spark, target, place, columns, by, (outcome, outcomes, not_value, total))
    # Plain names inside, so that no column can be called like another.
    kept = {**{f"k{i}": c for i, c in enumerate(by)}, **{f"n{i}": n for i, n in enumerate(names)}}
    kinds = [f"{own} {'STRING' if own[0] == 'k' else 'BIGINT'}" for own in kept]
    schema = ", ".join(["file_name STRING", *kinds, "landing STRING"])
    counted = _finished(spark, place)
    every = spark.createDataFrame([], schema)
    if counted:
        reader = spark.read.schema(schema).option("basePath", place)
        every = reader.parquet(*[f"{place}/landing={n}" for n in counted])
    current = current_files(spark, target).select("landing", "file_name")
    counts = every.join(current, ["landing", "file_name"], "left_semi")
    counts = counts.select(*[F.col(own).alias(name) for own, name in kept.items()])
    return tally_counts(counts, dim, on, group, names, key_value, broadcast_bytes)


def _count_landings(
    spark: SparkSession,
    target: str,
    place: str,
    columns: Sequence[str],
    by: Sequence[str],
    spec: tuple[str, Mapping[str, Any], Any, str],
) -> None:
    """Count the landings that ``place`` does not have yet, per file and ``by``."""
    new = sorted(set(landings(spark, target)) - set(_finished(spark, place)))
    if not new:
        return
    marks = [free_name("landing", columns), free_name("file_name", columns)]
    rows = landed_rows(spark, target, columns, new, marks)
    counts = count_per_key(rows, [*marks, *by], *spec)
    n = len(counts.columns) - len(marks) - len(by)
    counts = counts.toDF(
        "landing", "file_name", *[f"k{i}" for i in range(len(by))], *[f"n{i}" for i in range(n)]
    )
    staged, files = _folder(spark, f"{place}/_staged-{new[0]}-{new[-1]}")
    files.delete(staged, True)
    counts.write.partitionBy("landing").parquet(staged.toString())
    for number in new:
        final, _ = _folder(spark, f"{place}/landing={number}")
        part, _ = _folder(spark, f"{staged.toString()}/landing={number}")
        # A landing without rows has no folder; an empty one says that it was counted.
        done = files.rename(part, final) if files.exists(part) else files.mkdirs(final)
        if not done:
            raise OSError(f"cannot publish the counts of landing {number} in {place}")
    files.delete(staged, True)


def landed_rows(
    spark: SparkSession,
    target: str,
    columns: Sequence[str],
    among: Sequence[str],
    marks: Sequence[str],
) -> DataFrame:
    """``read_landing_csv`` of some landings; ``marks`` are what to call landing and file name."""
    plain = [f"c{i}" for i in range(len(columns))]
    rows = read_landing_csv(spark, target, plain, among=among)
    return rows.select(
        *[F.col(p).alias(c) for p, c in zip(plain, columns, strict=True)],
        F.col("landing").alias(marks[0]),
        F.col("file_name").alias(marks[1]),
    )


def refresh_incremental(
    spark: SparkSession,
    fact_incoming: str | Sequence[str],
    dim_incoming: str | Sequence[str],
    raw: str,
    state: str,
    table: str,
    fact_columns: Sequence[str],
    dim_columns: Sequence[str],
    spec: Mapping[str, object] = MEDALS,
    columns: Mapping[str, str] = MEDAL_COLUMNS,
    constraints: Constraints = MEDAL_CONSTRAINTS,
    key: str | None = "sport",
    buckets: int = 8,
    min_rows: int = 0,
    rules: Rules = (),
    schema_location: str | None = None,
) -> DataFrame:
    """The daily refresh from what was landed: of the fact only the new files are read.

    The incoming files are landed byte for byte under ``raw``, the fact's new landings are counted
    into ``state``, and the tally of all current files replaces the rows of ``table`` after the gate.
    Files that have not changed need not come again; one that comes again replaces its former self.
    """
    fact_raw, dim_raw = f"{raw.rstrip('/')}/fact", f"{raw.rstrip('/')}/dim"
    land_exact(spark, fact_incoming, fact_raw)
    land_exact(spark, dim_incoming, dim_raw)
    create_schema(spark, table.rpartition(".")[0] or "default", schema_location)
    create_table(spark, table, columns, key=key, buckets=buckets)
    marks = [free_name("landing", dim_columns), free_name("file_name", dim_columns)]
    rows = landed_rows(spark, dim_raw, dim_columns, landings(spark, dim_raw), marks)
    current = current_files(spark, dim_raw).select("landing", "file_name").toDF(*marks)
    dim = rows.join(current, marks, "left_semi").drop(*marks)
    result = tally_landed(spark, fact_raw, state, dim, fact_columns, **spec)
    replace_table(result, table, constraints, min_rows, rules=rules)
    return spark.table(table)


def _in(name: str, names: Sequence[str]) -> bool:
    return name.lower() in map(str.lower, names)


def _folder(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _finished(spark: SparkSession, place: str) -> list[str]:
    path, files = _folder(spark, place)
    if not files.exists(path):
        return []
    names = [status.getPath().getName() for status in files.listStatus(path)]
    return sorted(name.partition("=")[2] for name in names if name.startswith("landing="))

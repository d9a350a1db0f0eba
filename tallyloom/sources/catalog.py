"""Catalog lookups and names for SQL."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


def table_columns(spark: SparkSession, table: str) -> list[str]:
    """The table's column names in ordinal order, from the catalog alone."""
    return spark.table(table).columns


@dataclass(frozen=True)
class TableDetails:
    """What the catalog has of a table besides its columns."""

    kind: str
    location: str
    partitioned_by: tuple[str, ...]
    bucketed_by: tuple[str, ...]
    buckets: int


def table_details(spark: SparkSession, table: str) -> TableDetails:
    """One look at the catalog, which starts no job."""
    rows = [tuple(r)[:2] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()]
    heads = [name for name, _ in rows]
    # A column may be called like a heading or a detail, so the last one counts.
    start = len(heads) - 1 - heads[::-1].index("# Detailed Table Information")
    details = dict(rows[start:])
    partitions: list[str] = []
    if "# Partition Information" in heads[:start]:
        first = start - 1 - heads[:start][::-1].index("# Partition Information") + 2
        for name in heads[first:start]:
            if not name:
                break
            partitions.append(name)
    keys = re.findall(r"`((?:[^`]|``)*)`", details.get("Bucket Columns", ""))
    return TableDetails(
        details.get("Type", ""),
        details.get("Location", ""),
        tuple(partitions),
        tuple(key.replace("``", "`") for key in keys),
        int(details.get("Num Buckets", 0)),
    )


def name_for_sql(frames: Mapping[str, DataFrame]) -> None:
    """Make each DataFrame readable in ``spark.sql`` under its name."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)

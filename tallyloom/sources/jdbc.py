"""JDBC reads."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcDatabase:
    """A database; user and password are read from the environment when needed."""

    url: str
    driver: str | None = None
    user_env: str = "JDBC_USER"
    password_env: str = "JDBC_PASSWORD"

    def options(self) -> dict[str, str]:
        found = {
            "url": self.url,
            "driver": self.driver,
            "user": os.environ.get(self.user_env),
            "password": os.environ.get(self.password_env),
        }
        return {name: value for name, value in found.items() if value}


def read_jdbc(
    spark: SparkSession,
    database: JdbcDatabase,
    table: str | None = None,
    query: str | None = None,
    split_on: str | None = None,
    bounds: tuple[object, object] | None = None,
    splits: int = 64,
    fetch_size: int = 10_000,
    one_connection: bool = False,
) -> DataFrame:
    """Read a table, or the result of a query.

    A table is read over ``splits`` connections, a slice each of ``split_on``, which
    names a numeric, date or timestamp column, with ``bounds`` as its rough range. Rows
    outside the bounds, and NULLs, are still read, by the outer slices. Say
    ``one_connection`` to read a small table without. A query is read over one.
    Filters and columns reach the database.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    if (split_on is None) != (bounds is None):
        raise ValueError("split_on and bounds go together")
    if query is not None and split_on is not None:
        raise ValueError("only a table read can be split")
    if table is not None and one_connection == (split_on is not None):
        raise ValueError("a table needs either split_on or one_connection=True")
    reader = spark.read.format("jdbc").options(**database.options(), fetchsize=fetch_size)
    if query is not None:
        return reader.option("query", query).load()
    if split_on is not None:
        reader = reader.options(
            partitionColumn=split_on,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=splits,
        )
    return reader.option("dbtable", table).load()

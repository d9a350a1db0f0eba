"""JDBC output."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyloom.sources.jdbc import JdbcDatabase


def append_jdbc(
    df: DataFrame,
    database: JdbcDatabase,
    table: str,
    connections: int = 16,
    batch_size: int = 10_000,
    **options: object,
) -> None:
    """Append to a table, matching columns by name, over at most ``connections``.

    Each task commits on its own, so a lost executor can leave some rows written
    and a second run adds them again. Use :func:`replace_jdbc` for a result that
    is written as a whole.
    """
    _write(df, database, table, "append", connections, batch_size, options)


def replace_jdbc(
    df: DataFrame,
    database: JdbcDatabase,
    table: str,
    connections: int = 16,
    batch_size: int = 10_000,
    **options: object,
) -> None:
    """Empty the table, keeping its definition, and write; a second run changes nothing."""
    _write(
        df, database, table, "overwrite", connections, batch_size, {"truncate": True, **options}
    )


def _write(df, database, table, mode, connections, batch_size, options) -> None:
    # The shuffle keeps the work before the write parallel; the writer alone would narrow it.
    df.repartition(connections).write.format("jdbc").options(
        **database.options(),
        dbtable=table,
        numPartitions=connections,
        batchsize=batch_size,
        **options,
    ).mode(mode).save()

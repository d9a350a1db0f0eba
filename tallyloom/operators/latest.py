"""The latest row of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.names import column_of, free_name, quoted


def latest_per_key(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str | Column],
    ties: Sequence[str | Column] = (),
    nulls_first: bool = True,
) -> DataFrame:
    """Keep one row per ``key``: the first when sorted by ``order``, newest first.

    Names in ``order`` and ``ties`` sort descending, with NULL ahead of every
    value unless ``nulls_first`` is off; a sort expression such as
    ``F.asc("a")`` is taken as it is, and stands for the ``a`` of SQL's
    ``ORDER BY a, b DESC``. NULL keys are one key. Rows that stay
    equal are told apart arbitrarily, so give ``ties`` where that matters.

    Spark keeps the best row per key in each input task before it shuffles
    (``WindowGroupLimit``), so a hot key sends one row per task.
    """
    if not key or not order:
        raise ValueError("latest_per_key needs at least one key and one order column")

    def descending(name: str | Column) -> Column:
        if isinstance(name, Column):
            return name
        by = column_of(df, name)
        return by.desc_nulls_first() if nulls_first else by.desc_nulls_last()

    keys = [column_of(df, name) for name in key]
    window = Window.partitionBy(*keys).orderBy(*[descending(c) for c in (*order, *ties)])
    n = free_name("__n", df.columns)
    ranked = df.withColumn(n, F.row_number().over(window))
    return ranked.where(F.col(quoted(n)) == 1).drop(n)

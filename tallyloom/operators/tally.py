"""Conditional counts per group, on one table or over a fact-dimension join."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.names import column_of, free_name, quoted
from tallyloom.operators.prefilter import KeyFilter
from tallyloom.operators.size import fits


def _predicates(
    df: DataFrame, outcome: str, outcomes: Mapping[str, Any], not_value: Any, total: str
) -> dict[str, Column]:
    value_of = column_of(df, outcome)
    predicates = {
        name: value_of.isNull() if value is None else value_of == F.lit(value)
        for name, value in outcomes.items()
    }
    if not_value is not None:
        # A plain != on purpose: a NULL outcome is not counted.
        predicates[total] = value_of != F.lit(not_value)
    return predicates


def count_outcomes(
    df: DataFrame,
    group: str,
    outcome: str,
    outcomes: Mapping[str, Any],
    not_value: Any = None,
    total: str = "total",
) -> DataFrame:
    """Per ``group``, one count of rows for each named outcome value.

    ``outcomes`` maps a result column to the value it counts (``None`` counts
    NULLs). With ``not_value``, ``total`` counts the rows whose outcome is
    anything else. A NULL group is a group, and a group without hits keeps its
    row of zeros.
    """
    predicates = _predicates(df, outcome, outcomes, not_value, total)
    return df.groupBy(column_of(df, group)).agg(
        *[F.count(F.when(p, 1)).alias(name) for name, p in predicates.items()]
    )


def tally(
    fact: DataFrame,
    dim: DataFrame,
    on: str | tuple[str, str],
    group: str,
    outcome: str,
    outcomes: Mapping[str, Any],
    not_value: Any = None,
    total: str = "total",
    key_value: Any = None,
    broadcast_bytes: int = 64 << 20,
    prefilter: bool = False,
) -> DataFrame:
    """:func:`count_outcomes` over the inner join of ``fact`` to ``dim``.

    ``on`` names the join column, or the (fact, dim) pair; ``key_value`` keeps a
    single key. ``group`` is a column of either side, ``outcome`` one of the fact.
    A key that the dimension holds several times multiplies the counts, as the
    join would; the copies are counted first and used as a weight, so the repeated
    rows never exist. Where a key of the dimension has several groups, it is the
    fact that is counted first, per key, so no row is paired with all of them.

    The dimension is broadcast when it is one row (``key_value`` with a group of
    the fact) or when a measuring job over the columns used finds that they fit
    ``broadcast_bytes``. Otherwise the fact is counted per key and group in one pass,
    combined before its shuffle, and the counts meet the dimension in a sort-merge
    join: a hot key sends one row per task and group. Keys of different types are
    compared as Spark compares them in a join, so both ways count the same.

    ``prefilter`` is for a large dimension that has few of the fact's keys: a Bloom filter
    of its keys (:class:`KeyFilter`, one more job to size it) drops most other rows of the
    fact before they are counted and shuffled. It changes no result.
    """
    fact_key, dim_key = (on, on) if isinstance(on, str) else on
    predicates = _predicates(fact, outcome, outcomes, not_value, total)
    dim_groups = [] if _has(fact, group) else [group]
    weights = _Copies(dim, dim_key, dim_groups, key_value, [*fact.columns, *predicates])
    fits_all = weights.fit(key_value, broadcast_bytes)
    if not (fits_all and (not dim_groups or weights.one_row_per_key())):
        kept = KeyFilter(weights.used, weights.key).keep(fact, fact_key) if prefilter else fact
        per_key = count_per_key(
            kept, [fact_key, *([] if dim_groups else [group])], outcome, outcomes, not_value, total
        )
        return weights.sums(per_key, fact_key, group, list(predicates), fits_all)
    names = dict.fromkeys([fact_key, outcome, *([] if dim_groups else [group])])
    needed = fact.select(*[column_of(fact, name) for name in names])
    joined = weights.join(needed, fact_key, F.broadcast)
    counted = {n: F.when(p, weights.number).otherwise(0) for n, p in predicates.items()}
    return joined.groupBy(column_of(joined, group)).agg(
        *[F.sum(w).alias(n) for n, w in counted.items()]
    )


def count_per_key(
    fact: DataFrame,
    by: Sequence[str],
    outcome: str,
    outcomes: Mapping[str, Any],
    not_value: Any = None,
    total: str = "total",
) -> DataFrame:
    """:func:`count_outcomes` by several columns: counts that :func:`tally_counts` can go on with."""
    predicates = _predicates(fact, outcome, outcomes, not_value, total)
    return fact.groupBy(*[column_of(fact, name) for name in dict.fromkeys(by)]).agg(
        *[F.count(F.when(p, 1)).alias(name) for name, p in predicates.items()]
    )


def tally_counts(
    counts: DataFrame,
    dim: DataFrame,
    on: str | tuple[str, str],
    group: str,
    names: Sequence[str],
    key_value: Any = None,
    broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """:func:`tally` from counts per key (and group, if it is the fact's) made before.

    ``counts`` may hold several rows of a key and group, such as one for each file; ``names`` are its
    columns to sum.
    """
    fact_key, dim_key = (on, on) if isinstance(on, str) else on
    dim_groups = [] if _has(counts, group) else [group]
    weights = _Copies(dim, dim_key, dim_groups, key_value, counts.columns)
    by = dict.fromkeys([fact_key, *([] if dim_groups else [group])])
    per_key = counts.groupBy(*[column_of(counts, name) for name in by]).agg(
        *[F.sum(column_of(counts, name)).alias(name) for name in names]
    )
    return weights.sums(per_key, fact_key, group, names, weights.fit(key_value, broadcast_bytes))


def _has(df: DataFrame, name: str) -> bool:
    return name.lower() in map(str.lower, df.columns)


class _Copies:
    """How many rows the dimension has for each of its keys and groups."""

    def __init__(self, dim, dim_key, groups, key_value, taken):
        self.groups = groups
        self.key = free_name("__key", taken, dim.columns)
        copies = free_name("__copies", taken, dim.columns)
        self.number = F.col(copies)
        used = dim.select(
            column_of(dim, dim_key).alias(self.key), *[column_of(dim, g).alias(g) for g in groups]
        ).where(F.col(self.key).isNotNull())
        if key_value is not None:
            kind = used.schema[self.key].dataType
            used = used.where(F.col(self.key) == F.lit(key_value).cast(kind))
        self.used = used
        self.table = used.groupBy(*map(quoted, used.columns)).agg(F.count("*").alias(copies))

    def fit(self, key_value: Any, limit: int) -> bool:
        return (key_value is not None and not self.groups) or fits(self.used, limit)

    def one_row_per_key(self) -> bool:
        return self.table.groupBy(self.key).count().where(F.col("count") > 1).isEmpty()

    def join(self, rows: DataFrame, fact_key: str, hinted: Callable[[DataFrame], DataFrame]) -> DataFrame:
        keyed = rows.withColumn(self.key, column_of(rows, fact_key))
        return keyed.join(hinted(self.table), self.key)

    def sums(
        self, per_key: DataFrame, fact_key: str, group: str, names: Sequence[str], small: bool
    ) -> DataFrame:
        """The counts of each key times its copies, by group."""
        joined = self.join(per_key, fact_key, F.broadcast if small else lambda d: d.hint("merge"))
        return joined.groupBy(column_of(joined, group)).agg(
            *[F.sum(column_of(joined, n) * self.number).alias(n) for n in names]
        )

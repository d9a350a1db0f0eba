"""NOT NULL, length and key constraints, checked on a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallyloom.operators.names import column_of, free_name, quoted
from tallyloom.operators.quality import as_rules, require_observed


@dataclass(frozen=True)
class Constraints:
    """What a table promises; Spark keeps neither NOT NULL nor a key on Parquet."""

    not_null: tuple[str, ...] = ()
    max_length: Mapping[str, int] = field(default_factory=dict)
    key: tuple[str, ...] = ()

    def __bool__(self) -> bool:
        return bool(self.not_null or self.max_length or self.key)


def constraint_rules(df: DataFrame, table_name: str, constraints: Constraints) -> DataFrame:
    """One rule row per constraint, ready for ``require``; ``actual`` counts violations.

    The rules are ``null_<column>``, ``long_<column>`` and ``extra_keys``, the
    number of rows beyond the first of their key. All columns are checked in one
    scan without a shuffle. Keys are counted in another, which reads and shuffles
    nothing but keys and combines repeated ones first, so a hot key costs one row
    per task.
    """
    checks = {f"null_{c}": column_of(df, c).isNull() for c in constraints.not_null}
    checks |= {f"long_{c}": F.length(column_of(df, c)) > n for c, n in constraints.max_length.items()}
    found = []
    if checks:
        counts = [F.count(F.when(p, 1)).alias(name) for name, p in checks.items()]
        found.append(as_rules(df.agg(*counts), table_name))
    if constraints.key:
        n = free_name("extra", df.columns)
        keys = [column_of(df, c) for c in constraints.key]
        per_key = df.groupBy(*keys).agg((F.count("*") - 1).alias(n))
        extra = F.coalesce(F.sum(quoted(n)), F.lit(0)).alias("extra_keys")
        found.append(as_rules(per_key.agg(extra), table_name))
    if not found:
        raise ValueError("no constraint given")
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def observed_metrics(
    df: DataFrame, constraints: Constraints | None, predicates: Mapping[str, str]
) -> dict[str, Column]:
    """Aggregates by rule, for ``DataFrame.observe``: the row count, then counts of violations.

    The rules are ``row_count``, ``null_<column>``, ``long_<column>`` and the names of ``predicates``,
    whose conditions hold where they are true; a NULL is a violation. The aggregates are called
    ``m0``, ``m1`` and so on. Keys cannot be observed, since that takes a shuffle.
    """
    rules = constraints or Constraints()
    checks = {f"null_{c}": column_of(df, c).isNull() for c in rules.not_null}
    checks |= {f"long_{c}": F.length(column_of(df, c)) > n for c, n in rules.max_length.items()}
    checks |= {name: ~F.coalesce(F.expr(sql), F.lit(False)) for name, sql in predicates.items()}
    counts = {"row_count": F.count(F.lit(1))}
    counts |= {name: F.count(F.when(p, 1)) for name, p in checks.items()}
    return {name: count.alias(f"m{k}") for k, (name, count) in enumerate(counts.items())}


def observe_rules(
    df: DataFrame, table_name: str, constraints: Constraints | None = None,
    predicates: Mapping[str, str] | None = None, min_rows: int = 0,
) -> tuple[DataFrame, Callable[[], None]]:
    """``df`` that counts while something else reads it, and a gate to call afterwards.

    Write or collect the DataFrame once, then call the gate: it raises ``QualityError`` for each
    broken rule, and no row is read for it. Place it last before the write, since
    rows that run through a shuffle again after an executor is lost would count again.
    """
    metrics = observed_metrics(df, constraints, predicates or {})
    observation = Observation()

    def gate() -> None:
        found = observation.get
        values = [(rule, found.get(f"m{k}", 0)) for k, rule in enumerate(metrics)]
        require_observed(
            table_name,
            [(r, n, n >= min_rows if r == "row_count" else not n) for r, n in values],
        )

    return df.observe(observation, *metrics.values()), gate


def count_violations(df: DataFrame, constraints: Constraints) -> DataFrame:
    """:func:`constraint_rules` as one row, with a column for each rule."""
    names = [f"null_{c}" for c in constraints.not_null]
    names += [f"long_{c}" for c in constraints.max_length]
    names += ["extra_keys"] if constraints.key else []
    rules = constraint_rules(df, "", constraints)
    return rules.agg(
        *[F.max(F.when(F.col("rule") == name, F.col("actual"))).alias(name) for name in names]
    )

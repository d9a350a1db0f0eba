"""Column names: of any spelling, and new ones that clash with none."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """``name`` as SQL reads it, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def column_of(df: DataFrame, name: str) -> Column:
    """The column of that very name, dots included; else what Spark makes of the name."""
    known = {c.lower() for c in df.columns}
    return F.col(quoted(name) if name.lower() in known else name)


def free_name(base: str, *taken: Iterable[str]) -> str:
    """``base``, with as many underscores after it as no name in ``taken`` has."""
    used = {name.lower() for names in taken for name in names}
    while base.lower() in used:
        base += "_"
    return base

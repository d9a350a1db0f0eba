"""The measuring job behind every broadcast that is not of one row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ROW_OVERHEAD = 32  # bytes a broadcast row needs besides its values


def fits(df: DataFrame, limit: int) -> bool:
    """Whether all rows together stay under ``limit`` bytes; no rows reach the driver."""
    widths = [F.max(F.octet_length(F.col(c).cast("string"))) for c in df.columns]
    rows, *widest = df.agg(F.count("*"), *widths).first()
    return rows * (sum(w or 0 for w in widest) + _ROW_OVERHEAD) <= limit

"""Placing rows by a distribution key."""

from __future__ import annotations

from pyspark.sql import DataFrame


def co_locate(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Shuffle rows so that a write into ``buckets`` buckets of ``key`` makes few files.

    Without it every task of a bucketed write opens every bucket. A task gets the
    rows of one bucket, as both hash the key alike; adaptive execution joins small
    buckets in one task and splits a hot one over several.
    """
    return df.hint("rebalance", buckets, key)

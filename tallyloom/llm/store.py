"""Tables that cut a lineage, in the shared folder of the session."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import scratch_dir

SMALL = 32 << 20  # bytes up to which a measured table may be broadcast


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under ``spark.checkpoint.dir`` and read back."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, limit: int = SMALL) -> DataFrame:
    """``df`` with a broadcast hint if its rows measure under ``limit`` bytes, else as it is."""
    widths = [F.coalesce(F.octet_length(F.col(c).cast("binary")), F.lit(0)) for c, t in df.dtypes
              if t in ("string", "binary")]
    size = F.count("*") * (64 + 8 * len(df.columns))
    for width in widths:
        size = size + F.coalesce(F.sum(width), F.lit(0))
    return F.broadcast(df) if df.agg(size).first()[0] <= limit else df


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import the package from the driver's path.

    That is enough where the package lies at the same path everywhere, as in local
    mode. Elsewhere ship it with ``--py-files``. Batches of texts are kept to a
    thousand rows, which is what bounds a worker's memory.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))

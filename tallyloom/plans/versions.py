"""What files a table has, so that a change by another job is seen before it is lost."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tallyloom.sources.catalog import table_details

MARKER = "_replacing"


def table_version(spark: SparkSession, table: str, location: str | None = None) -> str:
    """A fingerprint of the table's files: their number, bytes, and a sum over path, length and time.

    Take it before a DataFrame that reads the table is made, and hand it to the replacing
    call as ``since``. The files are listed, not read, and no name reaches the caller.
    """
    location = location or table_details(spark, table).location
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(location)
        .where(~F.contains("path", F.lit("/staged-")))
    )
    each = F.xxhash64("path", "length", "modificationTime").cast("decimal(38, 0)")
    n, size, sums = files.agg(F.count("*"), F.sum("length"), F.sum(each)).first()
    return f"{location}|{n}|{size}|{sums}"


def check_version(spark: SparkSession, table: str, location: str, since: str) -> None:
    """Raise if the table's files are not those of ``since``."""
    if table_version(spark, table, location) != since:
        raise RuntimeError(f"{table} was changed by another job in the meantime")


@contextmanager
def held(spark: SparkSession, location: str, table: str) -> Iterator[None]:
    """Hold a marker in the table's folder that only one job can create.

    A driver that is killed while it holds one leaves the file ``_replacing`` behind, which then has to
    be deleted by hand.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(location, MARKER)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(path) or not files.createNewFile(path):
        raise RuntimeError(f"{table} is being replaced by another job: {path.toString()} is there")
    try:
        yield
    finally:
        files.delete(path, False)

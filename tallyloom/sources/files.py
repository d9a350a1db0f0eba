"""Files as rows: listing, lookup by exact path, whole contents, landed lines."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ATTRIBUTES = ("path", "length", "modificationTime")


def list_files(
    spark: SparkSession, prefix: str, glob: str | None = None, recursive: bool = True
) -> DataFrame:
    """``(path, length, modificationTime)`` of the files under ``prefix``.

    The contents are not read. ``glob`` matches the file name.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(prefix).select(*_ATTRIBUTES)


def find_file(spark: SparkSession, path: str) -> DataFrame:
    """The attributes of the one file at ``path``; raises when nothing is there.

    Only that path is asked for, so the size of its folder does not matter. A folder
    at ``path`` gives no row.
    """
    reader = spark.read.format("binaryFile")
    exact = re.sub(r"([\[\]{}*?\\])", r"\\\1", path.rstrip("/"))
    name = exact.rpartition("/")[2]
    return reader.option("pathGlobFilter", name).load(exact).select(*_ATTRIBUTES)


def read_files(
    spark: SparkSession, prefix: str, glob: str | None = None, recursive: bool = True
) -> DataFrame:
    """``(path, content)``: every file whole, decoded as UTF-8, one row per file.

    A row holds a whole file, which Spark limits to 2 GB. Use :func:`read_csv` or
    ``spark.read.text`` for larger ones; these split a file over tasks.
    """
    reader = spark.read.option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.text(prefix, wholetext=True)
    return files.select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("content")
    )


def read_landed(spark: SparkSession, target: str, file_name: str | None = None) -> DataFrame:
    """``(value, file_name)``: the lines that ``land_raw`` wrote, in no fixed order."""
    lines = (
        spark.read.schema("value string, file_name string").option("lineSep", "\n").text(target)
    )
    return lines if file_name is None else lines.where(F.col("file_name") == file_name)


def read_landed_csv(
    spark: SparkSession,
    target: str,
    columns: Sequence[str],
    file_name: str | None = None,
    sep: str = ",",
) -> DataFrame:
    """Landed CSV files as strings, without their header lines, which must read ``columns``.

    The landed parts of a large file have one header between them, so they cannot be
    scanned as CSV files. As lines have no order, one line per file that equals the
    header is left out; the second scan below finds any others, which are rows.
    """
    schema = ", ".join(f"`{c}` STRING" for c in columns)
    # A line of a file with Windows line ends still has the first half of its end.
    line = F.regexp_replace("value", "\\r$", "")
    fields = F.from_csv(line, schema, {"sep": sep, "escape": '"'})
    lines = read_landed(spark, target, file_name).where(~F.col("value").isin("", "\r"))
    parsed = lines.select("file_name", fields.alias("fields"))
    is_header = reduce(and_, [F.col(f"fields.`{c}`").eqNullSafe(F.lit(c)) for c in columns])
    headers = parsed.groupBy("file_name").agg(F.count(F.when(is_header, 1)).alias("n"))
    missing = F.raise_error(F.concat("file_name", F.lit(" has no such header")))
    others = F.when(F.col("n") == 0, missing).when(F.col("n") > 1, F.sequence(F.lit(2), "n"))
    spare = headers.select(F.explode(others)).select(*[F.lit(c).alias(c) for c in columns])
    return parsed.where(~is_header).select("fields.*").unionByName(spare)

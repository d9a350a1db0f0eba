"""Reading what ``land_exact`` landed: which files, their lines in order, CSV rows, whole texts.

Under the target, ``data/landing=<number>/file_name=<name>/start=<offset>`` holds the lines of a
file that begin in the split at that offset, in order, and ``manifest/landing=<number>`` one row for each
file of the landing. A landing without a manifest was not finished and is not there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F

MANIFEST = "file_name string, length long, modified timestamp, bom boolean, ended boolean"
_PLACE = "landing string, file_name string, start long"
_BOM = "﻿"


def landings(spark: SparkSession, target: str) -> list[str]:
    """The numbers of the finished landings, as text, oldest first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}/manifest")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    names = [status.getPath().getName() for status in files.listStatus(path)]
    return sorted(name.partition("=")[2] for name in names if name.startswith("landing="))


def landing_manifest(
    spark: SparkSession, target: str, among: Sequence[str] | None = None
) -> DataFrame:
    """(landing, file_name, length, modified, bom, ended) for each file of each landing.

    ``among`` keeps some landings; only theirs are listed and read.
    """
    numbers = landings(spark, target) if among is None else list(among)
    schema = f"{MANIFEST}, landing string"
    if not numbers:
        return spark.createDataFrame([], schema)
    base = f"{target.rstrip('/')}/manifest"
    reader = spark.read.schema(schema).option("basePath", base)
    return reader.parquet(*[f"{base}/landing={n}" for n in numbers])


def current_files(spark: SparkSession, target: str) -> DataFrame:
    """:func:`landing_manifest` with the last landing of each file only."""
    order = Window.partitionBy("file_name").orderBy(F.desc("landing"))
    ranked = landing_manifest(spark, target).withColumn("n", F.row_number().over(order))
    return ranked.where("n = 1").drop("n")


def read_landing(
    spark: SparkSession, target: str, among: Sequence[str] | None = None
) -> DataFrame:
    """(value, landing, file_name, start, part, block, seq): every landed line.

    Sorted by the last four columns, the lines of a landing's file are in the order of the source. ``seq`` only
    tells lines of one scan apart. Files that a later landing replaced are there
    too: join :func:`current_files` on landing and name to leave them out.
    """
    folders = _folders(spark, target, among)
    if not folders:
        places = "part string, block long, seq long"
        return spark.createDataFrame([], f"value string, {_PLACE}, {places}")
    lines = _landed(spark, target, "value string").option("lineSep", "\n")
    return lines.text(folders).select(
        "value",
        "landing",
        "file_name",
        "start",
        F.col("_metadata.file_name").alias("part"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
    )


def read_landing_files(spark: SparkSession, target: str) -> DataFrame:
    """(file_name, content): the current files, byte for byte, one row each.

    A row holds a whole file, which Spark limits to 2 GB; :func:`read_landing` has no such limit.
    """
    lines = read_landing(spark, target)
    texts = lines.groupBy("landing", "file_name").agg(
        F.sort_array(F.collect_list(F.struct("start", "part", "block", "seq", "value"))).alias("l")
    )
    content = F.array_join("l.value", "\n")
    # What the reader takes off, and what no line has: the mark at the start, the last line's end.
    ended = F.when(F.col("ended") & F.col("l").isNotNull(), "\n").otherwise("")
    bom = F.when(F.col("bom"), _BOM).otherwise("")
    files = current_files(spark, target).join(texts, ["landing", "file_name"], "left")
    return files.select(
        "file_name", F.concat(bom, F.coalesce(content, F.lit("")), ended).alias("content")
    )


def read_landing_csv(
    spark: SparkSession,
    target: str,
    columns: Sequence[str],
    among: Sequence[str] | None = None,
    header: bool = True,
    sep: str = ",",
) -> DataFrame:
    """The landed lines as CSV rows of strings, with ``landing`` and ``file_name``.

    Fields go by position. With ``header`` the first line of each file is left out, which is the first of
    those that were landed from offset 0. Each line is read and parsed once. A field
    with a line break in it is not put together again.
    """
    fields = ", ".join(f"`{c}` STRING" for c in columns)
    # A folder's lines are one file: only that at offset 0 begins with a header.
    scans = [("start = 0", True), ("start > 0", False)] if header else [("start >= 0", False)]
    folders = _folders(spark, target, among)
    if not folders:
        return spark.createDataFrame([], f"{fields}, {_PLACE}").drop("start")
    parts = [
        _landed(spark, target, fields)
        .options(header=skips, sep=sep, escape='"', lineSep="\n")
        .csv(folders)
        .where(where)
        for where, skips in scans
    ]
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    # A line's carriage return is the first half of its end.
    last = F.regexp_replace(F.col(f"`{columns[-1]}`"), "\r$", "")
    return rows.drop("start").withColumn(columns[-1], F.when(last != "", last))


def _landed(spark: SparkSession, target: str, fields: str) -> DataFrameReader:
    base = f"{target.rstrip('/')}/data"
    return spark.read.schema(f"{fields}, {_PLACE}").option("basePath", base)


def _folders(spark: SparkSession, target: str, among: Sequence[str] | None) -> list[str]:
    numbers = landings(spark, target) if among is None else list(among)
    return [f"{target.rstrip('/')}/data/landing={n}" for n in numbers]

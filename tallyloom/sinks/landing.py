"""Byte-exact landing of incoming files, in numbered landings."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.text import basename
from tallyloom.sources.landing import current_files, landings

_WRITTEN = (
    "path string, modificationTime timestamp, length long, content binary, file_name string, start long"
)


def land_exact(
    spark: SparkSession, source: str | Sequence[str], target: str, glob: str = "*.csv"
) -> str | None:
    """Copy the matching files under ``target`` so that they can be read back byte for byte.

    Returns the number of the landing, or None where no file matches. Lines keep their order: those
    that begin in one split of a file are written by the task that reads it into
    a folder of their own, named by the split's offset, so nothing is shuffled and a large file is spread over
    many tasks. A manifest written last has each file's length and time, and
    whether it begins with a byte order mark and its last line has an end, which no line shows.
    Its bytes are then all accounted for; a file that changed while it was landed
    stops the landing.

    The names of the listing, which Spark's reader holds on the driver, are all that is there of the files.
    Files are taken from the ``source`` folders, not from folders inside them, and are told apart by name
    alone; two of one name are refused before anything is written. A file landed
    before under the same name is replaced for readers the moment the manifest is there, also by an
    empty one; the former landing stays until :func:`vacuum_landings`. A landing
    that dies leaves no trace for readers. Files that the reader would unpack, such as
    ``.gz``, are refused by their length.
    """
    paths = [source] if isinstance(source, str) else list(source)
    target = target.rstrip("/")
    files = _listed(spark, paths, glob)
    if files is None:
        return None
    number = _claim(spark, target)
    data = f"{target}/data/landing={number}"
    _write_lines(spark, paths, glob, data)
    _write_manifest(spark, files, data, target, number)
    return number


def vacuum_landings(spark: SparkSession, target: str) -> list[str]:
    """Delete the landings of which no file is current; returns their numbers.

    Readers that started before may still need them.
    """
    used = {row["landing"] for row in current_files(spark, target).select("landing").distinct().collect()}
    unused = [number for number in landings(spark, target) if number not in used]
    for number in unused:
        for kind in ("manifest", "data"):
            path, files = _path(spark, f"{target.rstrip('/')}/{kind}/landing={number}")
            files.delete(path, True)
    return unused


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _listed(spark: SparkSession, paths: list[str], glob: str) -> DataFrame | None:
    """(file_name, length, modified) of the matching files; no contents are read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(paths)
    # A scan leaves empty files out, the reader's listing does not.
    names = Counter(unquote(path.rpartition("/")[2]) for path in files.inputFiles())
    if twice := sorted(name for name, times in names.items() if times > 1):
        raise ValueError(f"several files are called {', '.join(twice)}")
    if not names:
        return None
    listed = spark.createDataFrame([(name,) for name in names], "file_name string")
    scanned = files.select(
        basename("path").alias("file_name"), "length", F.col("modificationTime").alias("modified")
    )
    joined = listed.join(scanned, "file_name", "left")
    return joined.withColumn("length", F.coalesce("length", F.lit(0)))


def _claim(spark: SparkSession, target: str) -> str:
    """The next number, held by a marker that only one job can create."""
    last = max([0, *[int(n) for n in landings(spark, target)]])
    while True:
        last += 1
        marker, files = _path(spark, f"{target}/claims/{last:010d}")
        files.mkdirs(marker.getParent())
        if not files.exists(marker) and files.createNewFile(marker):
            return f"{last:010d}"


def _write_lines(spark: SparkSession, paths: list[str], glob: str, data: str) -> None:
    # Spark gives the name as a URI has it, where a plus sign is a plus sign.
    name = F.url_decode(F.replace("_metadata.file_name", F.lit("+"), F.lit("%2B")))
    lines = (
        spark.read.option("pathGlobFilter", glob)
        .option("lineSep", "\n")
        .text(paths)
        .select(
            "value",
            name.alias("file_name"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("seq"),
        )
    )
    # Within the task: the writer wants folders together, and this keeps their lines in order.
    ordered = lines.sortWithinPartitions("file_name", "start", "seq").drop("seq")
    ordered.write.option("lineSep", "\n").partitionBy("file_name", "start").text(data)


def _write_manifest(
    spark: SparkSession, files: DataFrame, data: str, target: str, number: str
) -> None:
    """Compare what was written, by its length alone, with each file's length."""
    landed = spark.createDataFrame([], "file_name string, landed long")
    folder, files_of = _path(spark, data)
    if any(status.isDirectory() for status in files_of.listStatus(folder)):
        written = spark.read.format("binaryFile").schema(_WRITTEN).option("pathGlobFilter", "part-*")
        landed = written.load(data).groupBy("file_name").agg(F.sum("length").alias("landed"))
    # The reader takes off a mark of three bytes, and the writer ends the last line.
    spare = F.col("length") - F.coalesce("landed", F.lit(0))
    changed = F.concat(F.col("file_name"), F.lit(" is not what was landed"))
    known = F.when(spare.isin(-1, 0, 2, 3), spare).otherwise(F.raise_error(changed).cast("long"))
    rows = (
        files.join(landed, "file_name", "left")
        .withColumn("spare", known)
        .select(
            "file_name",
            "length",
            "modified",
            (F.col("spare") > 0).alias("bom"),
            F.col("spare").isin(0, 3).alias("ended"),
        )
    )
    staged, _ = _path(spark, f"{target}/claims/manifest-{number}")
    rows.write.parquet(staged.toString())
    final, _ = _path(spark, f"{target}/manifest/landing={number}")
    files_of.mkdirs(final.getParent())
    if not files_of.rename(staged, final):
        raise OSError(f"cannot publish landing {number} of {target}")

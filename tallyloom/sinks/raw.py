"""Raw landing of incoming files."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.text import basename


def land_raw(
    spark: SparkSession, source: str | Sequence[str], target: str, glob: str = "*.csv"
) -> None:
    """Copy the lines of each matching file to ``target/file_name=<name>``.

    Files are taken from the ``source`` folders, not from plain folders inside them,
    and are told apart by name alone; two of one name are refused before anything is
    written. A file landed before under the same name is replaced, the others stay; an
    empty file leaves nothing under its name. Lines are kept byte for byte; where one
    input file is large, several tasks each write a part of it, so the order of its
    lines is not kept.
    """
    paths = [source] if isinstance(source, str) else list(source)
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(paths)
    # The listing that Spark's reader made; no contents are read.
    listed = Counter(unquote(path.rpartition("/")[2]) for path in files.inputFiles())
    twice = sorted(name for name, times in listed.items() if times > 1)
    if twice:
        raise ValueError(f"several files are called {', '.join(twice)}")
    # Spark gives the name as a URI has it, where a plus sign is a plus sign.
    name = F.url_decode(F.replace("_metadata.file_name", F.lit("+"), F.lit("%2B")))
    lines = (
        spark.read.option("pathGlobFilter", glob)
        .option("lineSep", "\n")
        .text(paths)
        .select("value", name.alias("file_name"))
    )
    (
        lines.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("lineSep", "\n")
        .partitionBy("file_name")
        .text(target)
    )
    # A scan leaves empty files out, so these are the names that the scan does not give.
    filled = files.where("length > 0").select(basename("path").alias("name")).collect()
    for empty in listed.keys() - {row["name"] for row in filled}:
        _remove(spark, target, empty)


def _remove(spark: SparkSession, target: str, name: str) -> None:
    """Remove the landed lines of ``name``, in whichever way its folder's name is escaped."""
    jvm = spark._jvm
    escape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    folder = jvm.org.apache.hadoop.fs.Path(target, f"file_name={escape(name)}")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    folder.getFileSystem(conf).delete(folder, True)

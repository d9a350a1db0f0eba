"""CSV scans from any path Spark can open."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Reader options a caller may set; Spark itself would ignore a misspelt one.
READ_OPTIONS = {
    "comment",
    "dateFormat",
    "emptyValue",
    "encoding",
    "ignoreLeadingWhiteSpace",
    "ignoreTrailingWhiteSpace",
    "lineSep",
    "locale",
    "mode",
    "multiLine",
    "nanValue",
    "negativeInf",
    "nullValue",
    "pathGlobFilter",
    "positiveInf",
    "quote",
    "recursiveFileLookup",
    "sep",
    "timestampFormat",
    "timestampNTZFormat",
    "timeZone",
}


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType | str | None = None,
    header: bool = True,
    infer: bool = False,
    trim: bool = False,
    strict: bool = False,
    escape: str = '"',
    **options: object,
) -> DataFrame:
    """Read delimited files; without ``schema`` or ``infer`` every column is a string.

    An empty field is NULL, in quotes too; with a ``nullValue`` that never occurs,
    such as ``\\N``, quotes make it an empty string. With ``schema`` fields go by
    position and the header line is only skipped. ``infer`` reads the files once
    more to guess the types. ``trim`` strips blanks around unquoted values.
    ``strict`` raises on a row that does not fit the schema, once its columns are
    read: a bare ``count()`` reads none. ``escape`` is the quote itself, as
    :func:`tallyloom.sinks.write_csv` writes; pass a backslash for Spark's own
    reading. A field with a line break in it needs ``multiLine``, which gives each
    file to one task.
    """
    unknown = sorted(set(options) - READ_OPTIONS)
    if unknown:
        raise ValueError(f"unknown read options: {', '.join(unknown)}")
    reader = spark.read.options(
        header=header,
        inferSchema=infer and schema is None,
        escape=escape,
        **options,
    )
    if trim:
        reader = reader.options(ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    if strict:
        reader = reader.option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(paths if isinstance(paths, str) else list(paths))

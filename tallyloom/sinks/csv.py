"""CSV output."""

from __future__ import annotations

from pyspark.sql import DataFrame

_MICROSECONDS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"  # Spark's default stops at milliseconds


def write_csv(
    df: DataFrame,
    path: str,
    single_file: bool = False,
    header: bool = True,
    mode: str = "overwrite",
) -> None:
    """Write CSV with a header line and ``"`` escaped by doubling; blanks are kept.

    Every task writes its own file. ``single_file`` gives one file, which one task
    writes row by row, however many there are: ask for it where the result is small.
    """
    # repartition, not coalesce: the work before the write stays parallel.
    _write(df.repartition(1) if single_file else df, path, header, mode)


def _write(df: DataFrame, path: str, header: bool, mode: str) -> None:
    # The line of a row that is one NULL would be empty, and Spark leaves it out.
    null_value = '""' if len(df.columns) == 1 else ""
    df.write.options(
        nullValue=null_value,
        header=header,
        escape='"',
        ignoreLeadingWhiteSpace=False,  # Spark would trim what it writes
        ignoreTrailingWhiteSpace=False,
        timestampFormat=_MICROSECONDS + "XXX",
        timestampNTZFormat=_MICROSECONDS,
    ).mode(mode).csv(path)

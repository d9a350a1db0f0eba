"""Column types that every value of a set of text files agrees with."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from tallyloom.operators.names import quoted
from tallyloom.sources.csv import read_csv

#: The types from the narrowest on; a value has the bit of each type that can hold it.
TYPES = ("boolean", "bigint", "double", "date", "timestamp")
_INTEGER = r"^(0|-?[1-9][0-9]*)\z"
_NUMBER = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?\z"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
_TIMESTAMP = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?"
    r"(Z|[+-][0-9]{2}:[0-9]{2})?\z"
)
_EXACT_DIGITS = 15  # that a double gives back as they were


def _fits(value: Column) -> Column:
    """The bits of the types that can hold ``value``, zero if it is only a text."""
    digits = F.length(F.regexp_replace(F.regexp_replace(value, "[eE].*$", ""), "^-?0*|[^0-9]", ""))
    number = value.rlike(_NUMBER) & (digits <= _EXACT_DIGITS) & F.abs(value.try_cast("double")).between(
        F.lit(0.0), F.lit(1.7976931348623157e308)
    )
    date = value.rlike(_DATE) & value.try_cast("date").isNotNull()
    holds = {
        "boolean": F.lower(value).isin("true", "false"),
        "bigint": value.rlike(_INTEGER) & value.try_cast("bigint").isNotNull(),
        "double": number,
        "date": date,
        "timestamp": date | (value.rlike(_TIMESTAMP) & value.try_cast("timestamp").isNotNull()),
    }
    bits = [F.when(holds[name], F.lit(1 << k)).otherwise(F.lit(0)) for k, name in enumerate(TYPES)]
    return F.when(value.isNotNull(), sum(bits[1:], bits[0]))


def narrowest_types(df: DataFrame) -> dict[str, str]:
    """For each text column the narrowest type that holds all its values.

    One aggregate over all rows: the bits of the types that hold a value, combined by AND
    in each task and then once more, so one row is shuffled a task and one reaches the
    driver. NULL fits everything; a column of NULLs alone is a string. A type must give the
    value back: a number with leading zeros or a plus sign, and one of more than 15 digits
    that is no ``bigint``, make a string of the column, and so does a ``bigint`` of more
    than 15 digits beside a fraction. Dates beside timestamps are timestamps.
    """
    if not df.columns:
        return {}
    agreed = df.agg(
        *[F.bit_and(_fits(F.col(quoted(c)))).alias(str(k)) for k, c in enumerate(df.columns)]
    ).first()
    return {
        c: next((name for k, name in enumerate(TYPES) if bits is not None and bits >> k & 1), "string")
        for c, bits in zip(df.columns, agreed, strict=True)
    }


def infer_schema(
    spark: SparkSession, paths: str | Sequence[str], **options: object
) -> StructType:
    """The schema for :func:`tallyloom.sources.read_csv` that no value of any file breaks.

    All files are read once, whole, with the ``options`` of ``read_csv``; a column that is an
    integer in one file and a fraction in another is a ``double``, and a text in any file
    makes it a string. Integers are ``bigint`` however small they are, so another day's
    files of the same kind have the same type. The type of an empty column is string.
    """
    rows = read_csv(spark, paths, **options)
    types = narrowest_types(rows)
    schema = StructType()
    for name in rows.columns:
        schema = schema.add(name, DataType.fromDDL(types[name]))
    return schema

"""Text helpers as column expressions."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F


def basename(path: str | Column) -> Column:
    """What follows the last ``/``, or the whole text without one."""
    return F.substring_index(path, "/", -1)


def first_chars(text: str | Column, n: int = 100) -> Column:
    """The first ``n`` characters."""
    return F.substring(text, 1, n)


def join_fields(sep: str, *fields: str | Column) -> Column:
    """The fields as text with ``sep`` between them; NULL fields are left out."""
    return F.concat_ws(sep, *fields)


MISSING = "(none)"


def fill_template(template: str, **fields: str | Column) -> Column:
    """``template`` with each ``{name}`` replaced by the column given for it.

    A NULL field is written as :data:`MISSING`, so the text is never lost.
    """
    parts: list[Column] = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            field = fields[name]
            value = (F.col(field) if isinstance(field, str) else field).cast("string")
            parts.append(F.coalesce(value, F.lit(MISSING)))
    return F.concat(*parts)

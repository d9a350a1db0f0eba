from tallyloom.functions.text import basename, fill_template, first_chars, join_fields
from tallyloom.functions.times import failure_report, shifted_time

__all__ = [
    "basename",
    "failure_report",
    "fill_template",
    "first_chars",
    "join_fields",
    "shifted_time",
]

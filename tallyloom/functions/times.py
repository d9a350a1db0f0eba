"""Timestamps shifted by a fixed number of hours, and the failure report built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from tallyloom.functions.text import fill_template

REPORT_TEMPLATE = "Job: {job_id}\nTask: {task_id}\nTime: {local_time}\nLog: {log_url}"


def shifted_time(df: DataFrame, ts: str, hours: int = 9) -> Column:
    """``ts`` in UTC plus ``hours``, as ``yyyy-MM-dd HH:mm:ss``.

    A fixed shift, whatever the session's time zone. A timestamp without a zone is
    taken as UTC.
    """
    if isinstance(df.schema[ts].dataType, TimestampNTZType):
        shifted = F.col(ts) + F.expr(f"INTERVAL '{hours}' HOUR")
        return F.substring(shifted.cast("string"), 1, 19)  # cuts off the fraction
    return F.expr(
        f"timestampadd(SECOND, unix_seconds(`{ts}`) + {hours} * 3600, "
        "TIMESTAMP_NTZ '1970-01-01 00:00:00')"
    ).cast("string")


def failure_report(
    runs: DataFrame,
    failed: Column,
    ts: str = "run_time",
    template: str = REPORT_TEMPLATE,
    hours: int = 9,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One ``report`` text per failed row of a job-run table.

    The template may name any column of ``runs``, and ``local_time`` for
    :func:`shifted_time` of ``ts``. ``keep`` names columns to carry along.
    """
    fields = {name: F.col(f"`{name}`") for name in runs.columns}
    fields["local_time"] = shifted_time(runs, ts, hours)
    report = fill_template(template, **fields).alias("report")
    return runs.where(failed).select(*keep, report)

import datetime

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import (
    basename,
    failure_report,
    fill_template,
    first_chars,
    join_fields,
    shifted_time,
)


def test_text(spark):
    df = spark.createDataFrame(
        [("a/b/c.csv", "é" * 150, None), ("plain", "x", "y"), ("dir/", "", "")],
        "p string, t string, n string",
    )
    result = df.select(
        basename("p"), first_chars("t", 100), join_fields(",", "p", "n"), fill_template("x", p="p")
    )
    assert [tuple(r) for r in result.collect()] == [
        ("c.csv", "é" * 100, "a/b/c.csv", "x"),
        ("plain", "x", "plain,y", "x"),
        ("", "", "dir/,", "x"),
    ]


def test_template(spark):
    df = spark.createDataFrame([("o'hara \\ $1", 2)], "name string, n int")
    text = fill_template("{{{name}}} has {n}%\n", name="name", n=F.col("n") + 1)
    assert df.select(text).first()[0] == "{o'hara \\ $1} has 3%\n"
    missing = fill_template("{a}: {b}", a=F.lit(None).cast("int"), b="n")
    assert df.select(missing).first()[0] == "(none): 2"


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Seoul"])
def test_shift_is_fixed_in_every_session_zone(spark, zone):
    # The second instant falls into New York's skipped hour once shifted.
    instants = ["2024-01-01 20:00:59.999", "2024-03-09 17:30:00"]
    expected = ["2024-01-02 05:00:59", "2024-03-10 02:30:00"]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for kind in ("TIMESTAMP", "TIMESTAMP_NTZ"):
            suffix = "+00:00" if kind == "TIMESTAMP" else ""
            df = spark.sql(
                " UNION ALL ".join(f"SELECT {kind} '{i}{suffix}' AS ts" for i in instants)
            )
            result = df.select(shifted_time(df, "ts").alias("t")).collect()
            assert sorted(r.t for r in result) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_failure_report(spark):
    runs = spark.createDataFrame(
        [
            ("j", "load", "http://log/1", datetime.datetime(2024, 1, 1, 20, 0), "failed"),
            ("j", "land", "http://log/2", datetime.datetime(2024, 1, 1, 20, 0), "ok"),
        ],
        "job_id string, task_id string, log_url string, run_time timestamp_ntz, status string",
    )
    reports = failure_report(runs, failed=F.col("status") == "failed", keep=("task_id",))
    assert [tuple(r) for r in reports.collect()] == [
        ("load", "Job: j\nTask: load\nTime: 2024-01-02 05:00:00\nLog: http://log/1")
    ]

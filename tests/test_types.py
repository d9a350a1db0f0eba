"""Types that all values of all files agree with."""

import pytest

from tallyloom.sources import infer_schema, narrowest_types, read_csv


@pytest.mark.parametrize(
    ("values", "kind"),
    [
        (["1", "-20", "0"], "bigint"),
        (["9223372036854775807"], "bigint"),
        (["9223372036854775808"], "string"),
        (["9223372036854775807", "0.5"], "string"),
        (["1", "2.50", "-1e3"], "double"),
        (["1e400"], "string"),
        (["0.1234567890123456789"], "string"),
        (["007"], "string"),
        (["+1"], "string"),
        (["1", "x"], "string"),
        (["true", "FALSE"], "boolean"),
        (["true", "1"], "string"),
        (["2024-02-29"], "date"),
        (["2023-02-29"], "string"),
        (["2024"], "bigint"),
        (["2024-02-29", "2024-03-01 10:00:00.123456"], "timestamp"),
        (["2024-02-29T10:00:00Z"], "timestamp"),
        (["2024-02-29", "5"], "string"),
        ([None, "3"], "bigint"),
        ([None], "string"),
        ([], "string"),
        (["", "3"], "string"),
        (["1\n"], "string"),
    ],
)
def test_narrowest(spark, values, kind):
    df = spark.createDataFrame([(v,) for v in values], "`a.b` string")
    assert narrowest_types(df) == {"a.b": kind}


def test_values_come_back(spark):
    values = ["0", "1.5", "-2.25", "123456789012345", "1e-7", "99999.00001"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert narrowest_types(df) == {"v": "double"}
    got = df.selectExpr("cast(v as double) as d").collect()
    assert [r["d"] for r in got] == [float(v) for v in values]


def test_files_that_disagree(spark, csv_file):
    paths = [
        csv_file("a.csv", "n,when,id,none\n1,2024-01-01,7,\n,,8,\n"),
        csv_file("b.csv", "n,when,id,none\n2.5,2024-01-02 10:00:00,x,\n"),
        csv_file("empty.csv", "n,when,id,none\n"),
    ]
    kinds = {f.name: f.dataType.simpleString() for f in infer_schema(spark, paths)}
    assert kinds == {"n": "double", "when": "timestamp", "id": "string", "none": "string"}
    rows = read_csv(spark, paths, schema=infer_schema(spark, paths), strict=True).collect()
    assert sorted(str(r["n"]) for r in rows) == ["1.0", "2.5", "None"]
    assert sorted(str(r["when"]) for r in rows) == ["2024-01-01 00:00:00", "2024-01-02 10:00:00", "None"]
    assert {r["id"] for r in rows} == {"7", "8", "x"}
    alone = {f.name: f.dataType.simpleString() for f in infer_schema(spark, paths[0])}
    assert alone == {"n": "bigint", "when": "date", "id": "bigint", "none": "string"}


def test_options_reach_the_reader(spark, csv_file):
    path = csv_file("in.csv", "n|s\n 5 | a \n")
    assert infer_schema(spark, path, sep="|", trim=True).simpleString() == "struct<n:bigint,s:string>"
    assert infer_schema(spark, path, sep="|").simpleString() == "struct<n:string,s:string>"
    assert len(infer_schema(spark, csv_file("none.csv", ""))) == 0


def test_one_aggregate_without_a_shuffle_of_rows(spark, csv_file):
    path = csv_file("in.csv", "a,b\n1,x\n")
    spark.sparkContext.setJobGroup("types", "")
    infer_schema(spark, path)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("types")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 3  # the header, and the aggregate with its one exchange

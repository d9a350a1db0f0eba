import glob
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException

from tallyloom.sinks import append_jdbc, land_raw, replace_jdbc, write_csv
from tallyloom.sources import (
    JdbcDatabase,
    find_file,
    list_files,
    read_csv,
    read_files,
    read_jdbc,
    read_landed,
    read_landed_csv,
    table_columns,
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def part_files(path):
    return glob.glob(f"{path}/part-*")


# --- CSV ---------------------------------------------------------------------


def test_quotes_and_commas_round_trip(spark, tmp_path):
    text = 'a "q" b, c'
    write_csv(spark.createDataFrame([(text, "")], "t string, e string"), str(tmp_path / "q"))
    lines = [open(f).read().splitlines() for f in part_files(tmp_path / "q")]
    assert ['t,e', '"a ""q"" b, c",""'] in lines
    assert rows(read_csv(spark, str(tmp_path / "q"))) == [(text, None)]
    assert rows(read_csv(spark, str(tmp_path / "q"), nullValue="\\N")) == [(text, "")]
    split = read_csv(spark, str(tmp_path / "q"), schema="a string, b string", escape="\\")
    assert rows(split) == [('"a ""q"" b', ' c"')]


texts = st.one_of(
    st.none(),
    st.text(st.characters(exclude_categories=["Cc", "Cs"]), max_size=8),
    st.text(' ,"\\\\\'#|\\t', max_size=5),
)


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(data=st.lists(st.tuples(texts, texts, texts), min_size=1, max_size=20))
def test_any_text_round_trips(spark, tmp_path, data):
    df = spark.createDataFrame(data, "a string, b string, c string")
    write_csv(df, str(tmp_path / "any"))
    back = read_csv(spark, str(tmp_path / "any"), schema=df.schema, nullValue="\0", strict=True)
    assert rows(back) == sorted(data, key=str)


def test_a_single_column_keeps_its_nulls(spark, tmp_path):
    for kind in ("string", "int", "timestamp"):
        df = spark.range(3).selectExpr(f"cast(nullif(id, 1) AS {kind}) AS c")
        write_csv(df, str(tmp_path / kind))
        back = read_csv(spark, str(tmp_path / kind), schema=df.schema, strict=True)
        assert rows(back) == rows(df)


def test_line_breaks_round_trip_with_multi_line(spark, tmp_path):
    df = spark.createDataFrame([("one\ntwo", "x"), ("three", None)], "a string, b string")
    write_csv(df, str(tmp_path / "breaks"))
    assert rows(read_csv(spark, str(tmp_path / "breaks"), multiLine=True)) == rows(df)


def test_strings_nulls_and_blanks(spark, csv_file):
    path = csv_file("in.csv", 'a,b\n1,\n 2 ," Silver "\n')
    assert rows(read_csv(spark, path)) == [(" 2 ", " Silver "), ("1", None)]
    assert rows(read_csv(spark, path, trim=True)) == [("1", None), ("2", " Silver ")]
    inferred = read_csv(spark, path, infer=True, trim=True)
    assert rows(inferred) == [(1, None), (2, " Silver ")]


def test_schema_goes_by_position(spark, csv_file):
    path = csv_file("in.csv", "x,y\n5,a\n")
    assert rows(read_csv(spark, path, schema="gold long, sport string")) == [(5, "a")]


def test_bad_rows(spark, csv_file):
    path = csv_file("in.csv", "g,s\n1,a,extra\nzz,b\n3\n")
    schema = "g long, s string"
    assert rows(read_csv(spark, path, schema=schema)) == [(1, "a"), (3, None), (None, "b")]
    strict = read_csv(spark, path, schema=schema, strict=True)
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        strict.collect()
    assert strict.count() == 3  # reads no column, so it sees nothing wrong


def test_unknown_option(spark, csv_file):
    with pytest.raises(ValueError, match="delim"):
        read_csv(spark, csv_file("in.csv", "a\n"), delim="|")
    piped = read_csv(spark, csv_file("p.csv", "a|b\n1|2\n"), sep="|")
    assert rows(piped) == [("1", "2")]


def test_only_used_columns_are_parsed_and_filters_reach_the_scan(spark, csv_file):
    path = csv_file("in.csv", "a,b,c\n1,2,3\n")
    plan = read_csv(spark, path).where("b = '2'").select("a")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<a:string,b:string>" in text
    assert "EqualTo(b,2)" in text


def test_single_file(spark, tmp_path):
    df = spark.range(100).repartition(4)
    write_csv(df, str(tmp_path / "one"), single_file=True)
    assert len(part_files(tmp_path / "one")) == 1
    write_csv(df, str(tmp_path / "many"))
    assert len(part_files(tmp_path / "many")) == 4
    write_csv(df.limit(0), str(tmp_path / "one"), single_file=True)
    assert [open(f).read() for f in part_files(tmp_path / "one")] == ["id\n"]


def test_microseconds_round_trip(spark, tmp_path):
    df = spark.sql(
        "SELECT TIMESTAMP_NTZ '2024-01-01 00:00:07.179575' AS n,"
        " TIMESTAMP '2024-01-01 00:00:07.179575' AS z"
    )
    write_csv(df, str(tmp_path / "t"))
    assert rows(read_csv(spark, str(tmp_path / "t"), schema=df.schema)) == rows(df)


# --- files -------------------------------------------------------------------


def test_list_find_and_read(spark, csv_file, tmp_path):
    csv_file("in/a.csv", "é\n1\n")
    csv_file("in/deep/b.csv", "b\n")
    csv_file("in/c.txt", "c")
    source = str(tmp_path / "in")
    listed = list_files(spark, source)
    assert [(p.rpartition("/")[2], n) for p, n, _ in rows(listed)] == [
        ("a.csv", 5),
        ("c.txt", 1),
        ("b.csv", 2),
    ]
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString()
    assert list_files(spark, source, glob="*.csv").count() == 2
    assert list_files(spark, source, glob="*.csv", recursive=False).count() == 1
    assert [r[1] for r in rows(find_file(spark, f"{source}/c.txt"))] == [1]
    assert find_file(spark, source).count() == find_file(spark, f"{source}/").count() == 0
    for name in ("b[1].csv", "b{1}*.csv"):
        path = csv_file(f"odd/{name}", "x\n")
        assert [r[1] for r in rows(find_file(spark, path))] == [2]
    with pytest.raises(PySparkException, match="PATH_NOT_FOUND"):
        find_file(spark, f"{source}/none.txt")
    assert {r.content for r in read_files(spark, source).collect()} == {"é\n1\n", "b\n", "c"}
    assert read_files(spark, source, glob="*.csv", recursive=False).count() == 1


def test_landing_replaces_by_name_and_keeps_the_rest(spark, csv_file, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "raw")
    csv_file("in/a.csv", 'h\n"x, y"\r\n\n')
    csv_file("in/b.csv", "h\nb1\nb1\n")
    csv_file("in/skip.txt", "no\n")
    csv_file("in/deep/c.csv", "no\n")
    land_raw(spark, source, target)
    a = [("", "a.csv"), ('"x, y"\r', "a.csv"), ("h", "a.csv")]
    b = [("b1", "b.csv"), ("b1", "b.csv"), ("h", "b.csv")]
    assert rows(read_landed(spark, target)) == sorted(a + b, key=str)
    os.remove(tmp_path / "in" / "a.csv")
    csv_file("in/b.csv", "h\nb2\n")
    land_raw(spark, source, target)
    assert rows(read_landed(spark, target, "b.csv")) == [("b2", "b.csv"), ("h", "b.csv")]
    assert rows(read_landed(spark, target, "a.csv")) == sorted(a, key=str)


def test_an_empty_file_replaces_too(spark, csv_file, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "raw")
    csv_file("in/a b=c+1%.csv", "h\na1\n")
    csv_file("in/b.csv", "h\nb1\n")
    land_raw(spark, source, target)
    assert read_landed(spark, target, "a b=c+1%.csv").count() == 2
    csv_file("in/a b=c+1%.csv", "")
    land_raw(spark, source, target)
    assert rows(read_landed(spark, target)) == [("b1", "b.csv"), ("h", "b.csv")]


def test_equal_names_are_refused(spark, csv_file, tmp_path):
    csv_file("one/a.csv", "x\n1\n")
    csv_file("two/a.csv", "x\n2\n")
    target = str(tmp_path / "raw")
    with pytest.raises(ValueError, match="called a.csv"):
        land_raw(spark, [str(tmp_path / "one"), str(tmp_path / "two")], target)
    assert not os.path.exists(target)


def test_windows_line_ends_read_as_csv(spark, csv_file, tmp_path):
    csv_file("in/w.csv", 'a,b\r\n1,"x, y"\r\n\r\n2,\r\n')
    land_raw(spark, str(tmp_path / "in"), str(tmp_path / "raw"))
    landed = read_landed_csv(spark, str(tmp_path / "raw"), ["a", "b"])
    assert rows(landed) == [("1", "x, y"), ("2", None)]


def test_a_large_file_lands_in_several_tasks(spark, csv_file, tmp_path):
    csv_file("in/big.csv", "".join(f"line {i}\n" for i in range(40_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100KB")
    try:
        land_raw(spark, str(tmp_path / "in"), str(tmp_path / "raw"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(part_files(tmp_path / "raw" / "file_name=big.csv")) > 2
    landed = read_landed(spark, str(tmp_path / "raw"))
    assert landed.select("value").distinct().count() == landed.count() == 40_000


def test_a_landed_file_reads_as_csv_again(spark, csv_file, tmp_path):
    lines = ["sport,noc"] + [f'"a ""{i}"", b",K{i}' for i in range(5_000)] + ["", "sport,noc", ",x"]
    path = csv_file("in/f.csv", "\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20KB")
    try:
        land_raw(spark, str(tmp_path / "in"), str(tmp_path / "raw"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(part_files(tmp_path / "raw" / "file_name=f.csv")) > 2
    landed = read_landed_csv(spark, str(tmp_path / "raw"), ["sport", "noc"])
    assert rows(landed) == rows(read_csv(spark, path))
    assert ("sport", "noc") in rows(landed) and landed.count() == 5_002
    with pytest.raises(Exception, match="f.csv has no such header"):
        read_landed_csv(spark, str(tmp_path / "raw"), ["noc", "sport"]).collect()
    csv_file("in/g.csv", "noc,sport\n1,2\n")
    land_raw(spark, str(tmp_path / "in"), str(tmp_path / "raw"))
    one = read_landed_csv(spark, str(tmp_path / "raw"), ["noc", "sport"], file_name="g.csv")
    assert rows(one) == [("1", "2")]


def test_table_columns(spark, schema):
    spark.sql(f"CREATE TABLE {schema}.c (z INT, a STRING, M INT) USING parquet")
    assert table_columns(spark, f"{schema}.c") == ["z", "a", "M"]
    spark.sql(f"CREATE TABLE {schema}.p (z INT, a STRING) USING parquet PARTITIONED BY (z)")
    assert table_columns(spark, f"{schema}.p") == spark.table(f"{schema}.p").columns == ["a", "z"]
    spark.range(1).createOrReplaceTempView("a_view")
    assert table_columns(spark, "a_view") == ["id"]


# --- JDBC, as far as it goes without a database --------------------------------


class Recorder:
    """Stands in for Spark's reader and writer and keeps what they are told."""

    def __init__(self):
        self.told = {}

    def format(self, name):
        self.told["format"] = name
        return self

    def options(self, **options):
        self.told |= options
        return self

    def option(self, name, value):
        self.told[name] = value
        return self

    def repartition(self, parts):
        self.parts = parts
        return self

    def mode(self, mode):
        self.told["mode"] = mode
        return self

    def load(self):
        return self.told

    def save(self):
        pass

    @property
    def read(self):
        return self

    @property
    def write(self):
        return self


@pytest.fixture
def database(monkeypatch):
    monkeypatch.setenv("JDBC_USER", "me")
    monkeypatch.setenv("JDBC_PASSWORD", "secret")
    return JdbcDatabase("jdbc:example://host/db", driver="example.Driver")


CONNECTION = {
    "format": "jdbc",
    "url": "jdbc:example://host/db",
    "driver": "example.Driver",
    "user": "me",
    "password": "secret",
}


def test_jdbc_read_options(database):
    assert read_jdbc(Recorder(), database, query="select 1") == {
        **CONNECTION,
        "fetchsize": 10_000,
        "query": "select 1",
    }
    split = read_jdbc(Recorder(), database, "t", split_on="id", bounds=(0, 9), splits=4)
    assert split == {
        **CONNECTION,
        "fetchsize": 10_000,
        "dbtable": "t",
        "partitionColumn": "id",
        "lowerBound": "0",
        "upperBound": "9",
        "numPartitions": 4,
    }
    for wrong in (
        {},
        {"table": "t", "query": "q"},
        {"table": "t"},
        {"table": "t", "split_on": "id"},
        {"table": "t", "split_on": "id", "bounds": (0, 1), "one_connection": True},
        {"query": "q", "split_on": "id", "bounds": (0, 1)},
    ):
        with pytest.raises(ValueError):
            read_jdbc(Recorder(), database, **wrong)


def test_jdbc_write_options(database):
    df = Recorder()
    append_jdbc(df, database, "s.t", createTableColumnTypes="sport VARCHAR(255)")
    assert df.told == {
        **CONNECTION,
        "dbtable": "s.t",
        "numPartitions": 16,
        "batchsize": 10_000,
        "createTableColumnTypes": "sport VARCHAR(255)",
        "mode": "append",
    }
    df = Recorder()
    replace_jdbc(df, database, "s.t")
    assert df.told["mode"] == "overwrite" and df.told["truncate"] is True
    assert df.parts == 16


def test_jdbc_without_a_driver_fails_loudly(spark):
    nowhere = JdbcDatabase("jdbc:nosuch:x")
    with pytest.raises(Exception, match="No suitable driver"):
        append_jdbc(spark.range(1), nowhere, "t")
    with pytest.raises(Exception, match="No suitable driver"):
        read_jdbc(spark, nowhere, "t", one_connection=True)

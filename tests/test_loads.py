import os

import pytest
from pyspark.errors import PySparkException

from tallyloom.operators import Constraints, QualityError
from tallyloom.plans import (
    create_table,
    create_table_as,
    drop_table,
    insert_into,
    load,
    load_fact_and_dimension,
    loads,
    replace_table,
    truncate_table,
)
from tallyloom.sinks import write_csv

COLUMNS = {"k": "INT", "o": "INT", "v": "STRING"}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def tables(spark, table):
    shown = spark.sql(f"SHOW TABLES IN {table.split('.')[0]}").where("NOT isTemporary")
    return [r.tableName for r in shown.collect()]


@pytest.fixture
def table(spark, schema):
    name = f"{schema}.t"
    create_table(spark, name, COLUMNS)
    insert_into(spark.createDataFrame([(0, 0, "a"), (1, 1, "a"), (2, 2, "a")], list(COLUMNS)), name)
    return name


def test_append(spark, table, csv_file):
    path = csv_file("in.csv", "x,y,z\n7,7,b\n")  # the header's names do not matter
    load(spark, table, path)
    assert rows(spark.table(table)) == [(0, 0, "a"), (1, 1, "a"), (2, 2, "a"), (7, 7, "b")]
    load(spark, table, csv_file("bare.csv", "8,8,c\n"), header=False)
    assert spark.table(table).count() == 5


def test_column_list_and_options(spark, table, csv_file):
    load(spark, table, csv_file("in.csv", "V|K\nb|9\n"), columns=["V", "k"], options={"sep": "|"})
    assert (9, None, "b") in rows(spark.table(table))
    with pytest.raises(ValueError, match="unknown read options: seperator"):
        load(spark, table, csv_file("in.csv", "V|K\nb|9\n"), options={"seperator": "|"})
    with pytest.raises(ValueError, match="no column nope"):
        load(spark, table, csv_file("in.csv", "V|K\nb|9\n"), columns=["nope"])


@pytest.mark.parametrize("bad", ["zz,1,b", "3,1", "1,1,b,extra"])
@pytest.mark.parametrize("mode", ["append", "truncate"])
def test_a_bad_row_stops_the_load(spark, table, csv_file, bad, mode):
    before = rows(spark.table(table))
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        load(spark, table, csv_file("in.csv", f"k,o,v\n1,1,a\n{bad}\n"), mode=mode)
    assert rows(spark.table(table)) == before


def test_truncate(spark, table, csv_file, tmp_path):
    load(spark, table, csv_file("in.csv", "k,o,v\n7,7,b\n"), mode="truncate")
    load(spark, table, csv_file("in.csv", "k,o,v\n8,8,b\n"), mode="truncate")
    assert rows(spark.table(table)) == [(8, 8, "b")]
    load(spark, table, csv_file("none.csv", "k,o,v\n"), mode="truncate")
    assert rows(spark.table(table)) == []
    # One folder of data stays, and no helper table.
    assert len(os.listdir(tmp_path / "tables")) == 1
    assert tables(spark, table) == ["t"]


def test_keep_latest_twice(spark, table, csv_file):
    path = csv_file("in.csv", "k,o,v\n0,9,b\n1,10,b\n0,3,c\n")
    for _ in range(2):
        load(
            spark,
            table,
            path,
            mode="keep_latest",
            key=["k"],
            order=["o"],
            constraints=Constraints(key=("k",)),
        )
        assert rows(spark.table(table)) == [(0, 9, "b"), (1, 10, "b"), (2, 2, "a")]


def test_keep_latest_null_keys_and_older_batch(spark, table, csv_file):
    insert_into(spark.createDataFrame([(None, 5, "n")], "k int, o int, v string"), table)
    path = csv_file("in.csv", "k,o,v\n,4,old\n2,1,old\n,,new\n")
    load(spark, table, path, "keep_latest", key=["k"], order=["o"])
    expected = [(0, 0, "a"), (1, 1, "a"), (2, 2, "a"), (None, None, "new")]
    assert rows(spark.table(table)) == expected


def test_keep_latest_collapses_old_duplicates(spark, table, csv_file):
    insert_into(spark.createDataFrame([(2, 5, "z")], "k int, o int, v string"), table)
    path = csv_file("none.csv", "k,o,v\n")
    load(spark, table, path, mode="keep_latest", key=["k"], order=["o"])
    assert rows(spark.table(table)) == [(0, 0, "a"), (1, 1, "a"), (2, 5, "z")]


@pytest.mark.parametrize("size", [1, 20_000])
def test_keep_latest_means_the_same_for_any_batch(spark, table, csv_file, size):
    insert_into(spark.createDataFrame([(1, 2, "b")], "k int, o int, v string"), table)
    path = csv_file("in.csv", "k,o,v\n" + "".join(f"{5 + i},1,n\n" for i in range(size)))
    load(spark, table, path, mode="keep_latest", key=["k"], order=["o"])
    assert rows(spark.table(table).where("k < 5")) == [(0, 0, "a"), (1, 2, "b"), (2, 2, "a")]
    assert spark.table(table).count() == 3 + size


@pytest.mark.parametrize("columns", ["k int, o int", "k int, o int, v string, w string"])
def test_other_columns_are_refused(spark, table, columns):
    before = rows(spark.table(table))
    df = spark.createDataFrame([], columns)
    for write in (insert_into, replace_table):
        with pytest.raises(ValueError, match="differ in columns: [vw]"):
            write(df, table)
    assert rows(spark.table(table)) == before


def test_scalar_rules_gate_every_mode(spark, table, csv_file):
    before = rows(spark.table(table))
    path = csv_file("in.csv", "k,o,v\n9,-1,b\n")
    negative = ("SELECT count(*) FROM {table} WHERE o < 0", 0)
    for mode in ("append", "truncate", "keep_latest"):
        with pytest.raises(QualityError, match="actual=1"):
            load(spark, table, path, mode=mode, key=["k"], order=["o"], rules=[negative])
        assert rows(spark.table(table)) == before
    load(spark, table, path, mode="truncate", rules=[("SELECT max(k) FROM {table}", 9)])
    assert rows(spark.table(table)) == [(9, -1, "b")]
    assert tables(spark, table) == ["t"]


def test_mode_arguments(spark, table, csv_file):
    path = csv_file("in.csv", "k,o,v\n")
    with pytest.raises(ValueError, match="needs a key"):
        load(spark, table, path, mode="keep_latest")
    with pytest.raises(ValueError, match="unknown load mode"):
        load(spark, table, path, mode="upsert")


@pytest.mark.parametrize("mode", ["append", "truncate", "keep_latest"])
def test_a_failed_gate_leaves_the_table(spark, table, csv_file, mode, tmp_path):
    before = rows(spark.table(table))
    path = csv_file("in.csv", "k,o,v\n4,1,\n")
    rules = Constraints(not_null=("v",))
    with pytest.raises(QualityError, match="null_v"):
        load(spark, table, path, mode, key=["k"], order=["o"], constraints=rules)
    with pytest.raises(QualityError, match="row_count"):
        load(spark, table, path, mode, key=["k"], order=["o"], min_rows=9)
    assert rows(spark.table(table)) == before
    assert tables(spark, table) == ["t"]
    assert len(os.listdir(tmp_path / "tables")) == 1


def test_checked_append(spark, table, csv_file):
    path = csv_file("in.csv", "k,o,v\n4,1,x\n")
    load(spark, table, path, constraints=Constraints(not_null=("v",), key=("k",)), min_rows=1)
    assert spark.table(table).count() == 4
    assert tables(spark, table) == ["t"]


def test_replace_reads_its_own_table_and_keeps_the_definition(spark, schema):
    name = f"{schema}.medals"
    create_table(spark, name, {"sport": "VARCHAR(5)", "n": "BIGINT"}, key="sport", buckets=4)
    insert_into(spark.createDataFrame([(1, "Judo"), (2, "Golf")], "n long, sport string"), name)
    replace_table(spark.table(name).selectExpr("sport", "n + 1 AS n"), name)
    assert rows(spark.table(name)) == [("Golf", 3), ("Judo", 2)]
    with pytest.raises(PySparkException, match="EXCEED_LIMIT_LENGTH"):
        replace_table(spark.createDataFrame([("Archery", 1)], "sport string, n long"), name)
    assert rows(spark.table(name)) == [("Golf", 3), ("Judo", 2)]
    plan = spark.table(name).groupBy("sport").count()._jdf.queryExecution().executedPlan()
    assert "Exchange" not in plan.toString()
    insert_into(spark.createDataFrame([("Polo", 1)], "sport string, n long"), name)
    assert spark.table(name).count() == 3


def test_folder_names_with_blanks(spark, tmp_path):
    spark.sql(f"CREATE SCHEMA blanks LOCATION '{tmp_path}/a b%20c'")
    create_table(spark, "blanks.t", {"k": "INT NOT NULL"})
    for n in (1, 2):
        replace_table(spark.range(n).selectExpr("cast(id AS int) AS k"), "blanks.t")
        assert spark.table("blanks.t").count() == n
    spark.sql("DROP SCHEMA blanks CASCADE")


def test_a_column_called_location(spark, schema):
    create_table(spark, f"{schema}.t", {"Location": "STRING"})
    replace_table(spark.createDataFrame([("here",)], ["Location"]), f"{schema}.t")
    assert rows(spark.table(f"{schema}.t")) == [("here",)]


def test_replace_can_keep_the_old_files(spark, table):
    old = spark.table(table)
    replace_table(spark.createDataFrame([(5, 5, "z")], list(COLUMNS)), table, keep_old=True)
    assert spark.table(table).count() == 1
    assert old.count() == 3  # a reader that started before


def test_a_second_writer_stops_the_first(spark, table, monkeypatch):
    gate = loads._gate

    def gate_while_another_job_replaces(*args):
        monkeypatch.setattr(loads, "_gate", gate)
        replace_table(spark.createDataFrame([(6, 6, "z")], list(COLUMNS)), table)

    monkeypatch.setattr(loads, "_gate", gate_while_another_job_replaces)
    with pytest.raises(RuntimeError, match="another job"):
        replace_table(spark.createDataFrame([(5, 5, "z")], list(COLUMNS)), table)
    assert rows(spark.table(table)) == [(6, 6, "z")]
    assert tables(spark, table) == ["t"]


def test_replace_refuses_a_partitioned_table(spark, schema):
    spark.range(3).selectExpr("id", "id % 2 AS p").write.partitionBy("p").saveAsTable(f"{schema}.p")
    with pytest.raises(ValueError, match="partitioned"):
        replace_table(spark.table(f"{schema}.p"), f"{schema}.p")


def test_replace_refuses_an_external_table(spark, schema, tmp_path):
    spark.range(3).write.option("path", str(tmp_path / "ours")).saveAsTable(f"{schema}.e")
    with pytest.raises(ValueError, match="external"):
        replace_table(spark.range(1), f"{schema}.e")
    assert spark.read.parquet(str(tmp_path / "ours")).count() == 3


def test_a_hot_bucket_is_written_by_several_tasks(spark, schema):
    """A third of the rows in one bucket, with a small target size per task."""
    name = f"{schema}.hot"
    create_table(spark, name, {"k": "BIGINT", "v": "STRING"}, key="k", buckets=4)
    df = spark.range(0, 60_000, 1, 16).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "sha2(cast(id AS string), 256) AS v"
    )
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(setting, "200KB")
    try:
        insert_into(df, name)
    finally:
        spark.conf.unset(setting)
    assert spark.table(name).count() == 60_000
    assert spark.table(name).where("k = 0").selectExpr("input_file_name() f").distinct().count() > 2


def test_truncate_table_and_create_as(spark, schema, table):
    create_table_as(spark.table(table), f"{schema}.copy")
    truncate_table(spark, table)
    assert spark.table(table).count() == 0
    insert_into(spark.table(f"{schema}.copy"), table)
    assert spark.table(table).count() == 3
    drop_table(spark, table)
    drop_table(spark, table)
    assert not spark.catalog.tableExists(table)


def test_load_fact_and_dimension(spark, schema, table, csv_file, tmp_path):
    create_table(spark, f"{schema}.dim", {"noc": "STRING"})
    write_csv(spark.range(4).selectExpr("id", "id", "'x' AS v"), str(tmp_path / "fact"))
    dim = csv_file("dim.csv", 'noc\n"a ""b"" c"\n')
    load_fact_and_dimension(spark, (table, str(tmp_path / "fact")), (f"{schema}.dim", dim))
    assert spark.table(table).count() == 4
    assert rows(spark.table(f"{schema}.dim")) == [('a "b" c',)]

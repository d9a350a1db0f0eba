import glob
import os
import subprocess
import sys
import time

import pytest

from tallyloom.__main__ import main
from tallyloom.operators import Constraints, QualityError
from tallyloom.plans import MEDALS, local_extract, refresh
from tallyloom.session import object_path, object_store_conf, scratch_dir
from tallyloom.sources import read_landed
from test_tally import FACT_A, FACT_B, ONE


@pytest.fixture
def run(spark, csv_file, tmp_path):
    name = f"medals_{abs(hash(str(tmp_path)))}"

    def refresh_with(fact, **options):
        return refresh(
            spark,
            incoming=str(tmp_path / "in"),
            raw=str(tmp_path / "raw"),
            fact_path=csv_file("in/events.csv", fact),
            dim_path=csv_file("in/regions.csv", ONE),
            table=f"{name}.medals",
            schema_location=str(tmp_path / "tables"),
            **options,
        )

    yield refresh_with
    spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")


CLEAN = FACT_A.replace(",KOR,Bronze\n", "")


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_refresh_lands_publishes_and_can_run_again(spark, run, tmp_path):
    expected = {("Judo", 2, 0, 0, 3), ("Archery", 0, 0, 0, 0)}
    assert rows(run(CLEAN)) == expected
    published = run(CLEAN)
    published.show()
    assert rows(published) == expected
    assert published.count() == 2
    landed = read_landed(spark, str(tmp_path / "raw"), "events.csv")
    assert sorted(r.value for r in landed.collect()) == sorted(CLEAN.splitlines())
    assert rows(run(CLEAN + "Polo,KOR,Silver\n")) == expected | {("Polo", 0, 1, 0, 1)}


def test_refresh_keeps_the_old_result_when_the_gate_fails(spark, run):
    good = run(CLEAN)
    expected = rows(good)
    with pytest.raises(QualityError, match="rule=null_sport, actual=1"):
        run(FACT_A)
    with pytest.raises(QualityError, match="row_count=2"):
        run(CLEAN, min_rows=3)
    with pytest.raises(QualityError, match="actual=2"):
        run(CLEAN, rules=[("SELECT count(*) FROM {table}", 3)])
    assert rows(good) == expected


def test_refresh_refuses_a_table_of_other_columns(spark, run):
    spec = {**MEDALS, "outcomes": {"gold": "Gold"}}
    columns = {"sport": "STRING", "gold": "BIGINT", "total": "BIGINT"}
    good = run(CLEAN, spec=spec, columns=columns, constraints=Constraints())
    with pytest.raises(ValueError, match="differ in columns: bronze, silver"):
        run(CLEAN)
    assert rows(good) == {("Judo", 2, 3), ("Archery", 0, 0)}


def test_local_extract(spark, csv_file, tmp_path):
    fact, dim = csv_file("fact.csv", FACT_B), csv_file("dim.csv", ONE)
    out = str(tmp_path / "out")
    assert rows(local_extract(spark, fact, dim, out)) == {("Judo", 1, 1, 1, 3)}
    (part,) = glob.glob(f"{out}/part-*")
    assert open(part).read() == "sport,gold,silver,bronze,total\nJudo,1,1,1,3\n"
    typed = {"fact_schema": "sport string, noc string, medal string", "dim_schema": "noc string"}
    assert rows(local_extract(spark, fact, dim, out, **typed)) == {("Judo", 1, 1, 1, 3)}


def test_object_store(monkeypatch):
    assert object_path("bucket", "key/", "f.csv") == "s3a://bucket/key/f.csv"
    monkeypatch.delenv("AWS_ACCESS_KEY_ID", raising=False)
    assert "spark.hadoop.fs.s3a.access.key" not in object_store_conf()
    monkeypatch.setenv("AWS_ACCESS_KEY_ID", "a")
    monkeypatch.setenv("AWS_SECRET_ACCESS_KEY", "b")
    conf = object_store_conf(endpoint="e", credentials_provider="p")
    assert conf == {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.endpoint": "e",
        "spark.hadoop.fs.s3a.aws.credentials.provider": "p",
        "spark.hadoop.fs.s3a.access.key": "a",
        "spark.hadoop.fs.s3a.secret.key": "b",
    }


class FakeSession:
    """A session's settings and master, without the session."""

    def __init__(self, master):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda name, default: None)})


def test_scratch_folder(spark):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(FakeSession("yarn"), "x")
    one, two = (scratch_dir(spark, "x") for _ in range(2))
    assert one != two and one.rpartition("/")[0] == two.rpartition("/")[0]
    base = spark.conf.get("spark.checkpoint.dir", None)
    assert one.startswith(base or spark.conf.get("spark.sql.warehouse.dir"))


LEAVES_NOTHING = """
import sys
from pyspark.sql import SparkSession
from tallyloom.session import scratch_dir
spark = (
    SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
    .config("spark.checkpoint.dir", sys.argv[1]).getOrCreate()
)
path = scratch_dir(spark, "x")
spark.range(3).write.parquet(path)
assert spark.read.parquet(path).count() == 3 and path.startswith(sys.argv[1] + "/tallyloom-")
"""


def test_nothing_stays_behind(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    command = [sys.executable, "-c", LEAVES_NOTHING, str(tmp_path / "shared")]
    subprocess.run(command, check=True, cwd=root, timeout=120)
    # Spark's own empty checkpoint folder is not ours.
    left = lambda: [n for n in os.listdir(tmp_path / "shared") if n.startswith("tallyloom")]
    for _ in range(50):  # the JVM ends a little after the driver's Python
        if not left():
            break
        time.sleep(0.2)
    assert left() == []


def test_command_line(spark, csv_file, tmp_path, schema, capsys):
    fact, dim = csv_file("in/fact.csv", CLEAN), csv_file("in/dim.csv", ONE)
    paths = ["--fact", fact, "--dim", dim]
    main(["extract", *paths, "--result", str(tmp_path / "out")])
    folders = ["--incoming", str(tmp_path / "in"), "--raw", str(tmp_path / "raw")]
    main(["refresh", *folders, *paths, "--table", f"{schema}.medals"])
    assert capsys.readouterr().out.count("|   Judo|   2|") == 2
    spark.sql(f"CREATE TABLE {schema}.noc (noc STRING) USING parquet")
    for _ in range(2):
        latest = ["--mode", "keep_latest", "--key", "noc", "--order", "noc", "--ties", "noc"]
        latest += ["--options", "sep=,", "--min-rows", "2"]
        latest += ["--rule", "SELECT count(*) FROM {table} WHERE noc = ''", "0"]
        main(["load", "--table", f"{schema}.noc", "--paths", dim, *latest])
    assert rows(spark.table(f"{schema}.noc")) == {("KOR",), ("USA",)}
    check = ["check", "--tables", f"{schema}.noc", f"{schema}.medals"]
    main(check)
    main([*check[:3], "--not-null", "noc"])
    with pytest.raises(QualityError, match="row_count=2"):
        main([*check, "--min-rows", "3"])
    spark.sql(f"INSERT INTO {schema}.noc VALUES (NULL)")
    with pytest.raises(QualityError, match="rule=noc, actual=1"):
        main([*check[:3], "--not-null", "noc"])
    with pytest.raises(SystemExit):
        main(["load", "--table", "t"])

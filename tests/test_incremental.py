"""The tally of landed files: equal to the whole one, and read from new files only."""

import shutil

import pytest

from tallyloom.operators import Constraints, QualityError, tally
from tallyloom.plans import refresh_incremental, tally_landed
from tallyloom.sinks import land_exact, vacuum_landings
from tallyloom.sources import read_csv

COLUMNS = ["sport", "noc", "medal"]
SPEC = {
    "on": "noc",
    "group": "sport",
    "outcome": "medal",
    "outcomes": {"gold": "Gold", "none": None},
    "not_value": "NA",
}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def put(tmp_path):
    def write(name, lines, folder="in"):
        path = tmp_path / folder / name
        path.parent.mkdir(exist_ok=True)
        path.write_text("sport,noc,medal\n" + "".join(f"{line}\n" for line in lines))

    return write


@pytest.fixture
def dim(spark):
    return spark.createDataFrame([("KOR",), ("KOR",), ("USA",)], ["noc"])


DAYS = [
    {"a.csv": ["Judo,KOR,Gold", "Judo,KOR,NA", "Golf,USA,"], "b.csv": ["Judo,USA,Gold", "Polo,XXX,Gold"]},
    {"a.csv": ["Judo,KOR,NA", "Swim,KOR,Gold"], "c.csv": ["Judo,KOR,Gold", '"a, b",USA,Gold']},
    {"c.csv": []},
]


def test_equals_the_whole_tally_and_reads_new_files_only(spark, put, dim, tmp_path):
    target, state = str(tmp_path / "raw"), str(tmp_path / "state")
    assert rows(tally_landed(spark, target, state, dim, COLUMNS, **SPEC)) == []
    for day, files in enumerate(DAYS):
        folder = f"day{day}"
        for name, lines in files.items():
            put(name, lines)
            put(name, lines, folder)
        land_exact(spark, str(tmp_path / folder), target)
        whole = tally(read_csv(spark, str(tmp_path / "in")), dim, **SPEC)
        got = tally_landed(spark, target, state, dim, COLUMNS, **SPEC)
        assert rows(got) == rows(whole)
        assert got.columns == whole.columns
        # What was counted is not needed again.
        shutil.rmtree(tmp_path / f"raw/data/landing=000000000{day + 1}")
    assert rows(tally_landed(spark, target, state, dim, COLUMNS, **SPEC)) == rows(whole)
    usa = dim.where("noc = 'USA'")
    assert rows(tally_landed(spark, target, state, usa, COLUMNS, **SPEC)) == rows(
        tally(read_csv(spark, str(tmp_path / "in")), usa, **SPEC)
    )


def test_scans_the_new_landing_only(spark, put, dim, tmp_path, monkeypatch):
    from tallyloom.plans import incremental

    target, state = str(tmp_path / "raw"), str(tmp_path / "state")
    scanned = []
    plain = incremental.read_landing_csv

    def recorded(*args, **kwargs):
        df = plain(*args, **kwargs)
        scanned.append({f.split("landing=")[1][:10] for f in df.inputFiles()})
        return df

    monkeypatch.setattr(incremental, "read_landing_csv", recorded)
    for day in range(2):
        for name, lines in DAYS[day].items():
            put(name, lines, f"day{day}")
        land_exact(spark, str(tmp_path / f"day{day}"), target)
        tally_landed(spark, target, state, dim, COLUMNS, **SPEC)
    tally_landed(spark, target, state, dim, COLUMNS, **SPEC)
    assert scanned == [{"0000000001"}, {"0000000002"}]


def test_another_tally_of_the_same_files(spark, put, tmp_path):
    """Grouped by the dimension, with names that the landing uses itself, in the same state."""
    target, state = str(tmp_path / "raw"), str(tmp_path / "state")
    for name, lines in DAYS[0].items():
        put(name, lines)
    land_exact(spark, str(tmp_path / "in"), target)
    dim = spark.createDataFrame([("KOR", "x"), ("USA", "y"), ("USA", "z")], ["code", "area"])
    spec = {"outcome": "start", "outcomes": {"landing": "Gold"}, "group": "area", "on": ("file_name", "code")}
    got = tally_landed(spark, target, state, dim, ["value", "file_name", "start"], **spec)
    assert rows(got) == [("x", 1), ("y", 1), ("z", 1)]
    one = tally_landed(spark, target, state, dim, ["value", "file_name", "start"], key_value="USA", **spec)
    assert rows(one) == [("y", 1), ("z", 1)]
    assert rows(tally_landed(spark, target, state, dim.withColumnRenamed("code", "noc"), COLUMNS, **SPEC)) != []


def test_a_count_that_died_is_made_again(spark, put, dim, tmp_path, monkeypatch):
    from tallyloom.plans import incremental

    target, state = str(tmp_path / "raw"), str(tmp_path / "state")
    for name, lines in DAYS[0].items():
        put(name, lines)
    land_exact(spark, str(tmp_path / "in"), target)
    with monkeypatch.context() as patch:
        patch.setattr(incremental, "count_per_key", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            tally_landed(spark, target, state, dim, COLUMNS, **SPEC)
    whole = tally(read_csv(spark, str(tmp_path / "in")), dim, **SPEC)
    assert rows(tally_landed(spark, target, state, dim, COLUMNS, **SPEC)) == rows(whole)


def test_refresh(spark, put, tmp_path):
    name = f"inc_{abs(hash(str(tmp_path)))}"
    (tmp_path / "dims").mkdir()
    (tmp_path / "dims/regions.csv").write_text("noc,region\nKOR,Korea\nUSA,X\n")

    def run(folder, **more):
        return refresh_incremental(
            spark,
            str(tmp_path / folder),
            str(tmp_path / "dims"),
            str(tmp_path / "raw"),
            str(tmp_path / "state"),
            f"{name}.medals",
            COLUMNS,
            ["noc", "region"],
            schema_location=str(tmp_path / "tables"),
            **more,
        )

    try:
        put("a.csv", ["Judo,KOR,Gold", "Judo,USA,Gold", "Golf,KOR,NA"], "one")
        put("a.csv", ["Judo,KOR,Silver"], "two")
        put("b.csv", ["Polo,KOR,Bronze"], "two")
        assert rows(run("one")) == [("Golf", 0, 0, 0, 0), ("Judo", 1, 0, 0, 1)]
        assert rows(run("two")) == [("Judo", 0, 1, 0, 1), ("Polo", 0, 0, 1, 1)]
        with pytest.raises(QualityError):
            run("two", constraints=Constraints(max_length={"sport": 1}))
        assert rows(run("two")) == [("Judo", 0, 1, 0, 1), ("Polo", 0, 0, 1, 1)]
        assert "0000000001" in vacuum_landings(spark, str(tmp_path / "raw/fact"))
        assert rows(run("two")) == [("Judo", 0, 1, 0, 1), ("Polo", 0, 0, 1, 1)]
    finally:
        spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")

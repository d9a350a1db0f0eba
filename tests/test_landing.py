"""Landing byte for byte, and reading it back in order."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from tallyloom.sinks import land_exact, vacuum_landings
from tallyloom.sources import (
    current_files,
    landing_manifest,
    landings,
    read_landing,
    read_landing_csv,
    read_landing_files,
)


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20KB")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def put(tmp_path, name, content):
    path = tmp_path / "in" / name
    path.parent.mkdir(exist_ok=True)
    path.write_bytes(content)


def hashes(spark, target):
    rows = read_landing_files(spark, target).select("file_name", F.sha2(F.col("content").cast("binary"), 256).alias("h"))
    return {r["file_name"]: r["h"] for r in rows.collect()}


def sha(content):
    return hashlib.sha256(content).hexdigest()


FILES = {
    "ended.csv": b"h,g\n1,2\n3,4\n",
    "open.csv": b"h,g\n1,2\n3,4",
    "windows.csv": b"h,g\r\n1,2\r\n\r\n3,4\r\n",
    "windows open.csv": b"h,g\r\n1,2\r",
    "mark.csv": b"\xef\xbb\xbfh,g\n1,2\n",
    "mark open.csv": b"\xef\xbb\xbfh,g\n1,2",
    "only mark.csv": b"\xef\xbb\xbf",
    "empty.csv": b"",
    "one line end.csv": b"\n",
    "line ends.csv": b"\n\n\n",
    "blanks+and=signs%20.csv": b" a \n\t\n b",
    "bytes.csv": b"h\n\xff\xfe\x00\n\xc3",
}


def test_every_byte_comes_back(spark, tmp_path):
    for name, content in FILES.items():
        put(tmp_path, name, content)
    put(tmp_path, "other.txt", b"not asked for")
    target = str(tmp_path / "raw")
    assert land_exact(spark, str(tmp_path / "in"), target) == "0000000001"
    assert hashes(spark, target) == {name: sha(content) for name, content in FILES.items()}
    lengths = {r["file_name"]: r["length"] for r in landing_manifest(spark, target).collect()}
    assert lengths == {name: len(content) for name, content in FILES.items()}


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("tail", [True, False])
def test_a_file_over_several_splits(spark, tmp_path, small_splits, end, tail):
    content = end.join(f"line {i} {'x' * (i % 90)}" for i in range(8_000)).encode()
    content += end.encode() if tail else b""
    for name in ("a.csv", "b.csv"):
        put(tmp_path, name, content if name == "a.csv" else content[::-1])
    target = str(tmp_path / "raw")
    land_exact(spark, str(tmp_path / "in"), target)
    assert len(os.listdir(tmp_path / "raw/data/landing=0000000001/file_name=a.csv")) > 10
    assert hashes(spark, target) == {"a.csv": sha(content), "b.csv": sha(content[::-1])}
    lines = read_landing(spark, target).where("file_name = 'a.csv'").orderBy("start", "part", "block", "seq")
    assert [r["value"] for r in lines.collect()] == content.decode().removesuffix("\n").split("\n")


def test_landing_shuffles_no_lines(spark, tmp_path, monkeypatch):
    put(tmp_path, "a.csv", b"x\n" * 50)
    plans = []
    writer = type(spark.range(1).write)
    plain = writer.text
    monkeypatch.setattr(
        writer, "text", lambda self, path: (plans.append(self._df._jdf.queryExecution().toString()), plain(self, path))
    )
    land_exact(spark, str(tmp_path / "in"), str(tmp_path / "raw"))
    assert len(plans) == 1 and "Exchange" not in plans[0]


def test_replacing_and_keeping(spark, tmp_path):
    target = str(tmp_path / "raw")
    assert land_exact(spark, str(tmp_path), target) is None and landings(spark, target) == []
    assert read_landing_files(spark, target).collect() == []
    put(tmp_path, "a.csv", b"h\n1\n" * 9)
    put(tmp_path, "b.csv", b"h\n2\n")
    land_exact(spark, str(tmp_path / "in"), target)
    os.remove(tmp_path / "in/b.csv")
    put(tmp_path, "a.csv", b"h\n3")
    assert land_exact(spark, str(tmp_path / "in"), target) == "0000000002"
    assert hashes(spark, target) == {"a.csv": sha(b"h\n3"), "b.csv": sha(b"h\n2\n")}
    assert vacuum_landings(spark, target) == []
    put(tmp_path, "a.csv", b"")
    land_exact(spark, str(tmp_path / "in"), target)
    assert hashes(spark, target) == {"a.csv": sha(b""), "b.csv": sha(b"h\n2\n")}
    assert {r["file_name"]: r["landing"][-1] for r in current_files(spark, target).collect()} == {"a.csv": "3", "b.csv": "1"}
    assert vacuum_landings(spark, target) == ["0000000002"]
    assert hashes(spark, target) == {"a.csv": sha(b""), "b.csv": sha(b"h\n2\n")}


def test_refusals(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "raw")
    for folder in ("one", "two"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "a.csv").write_bytes(b"x\n")
    with pytest.raises(ValueError, match="called a.csv"):
        land_exact(spark, [str(tmp_path / "one"), str(tmp_path / "two")], target)
    assert not os.path.exists(target)

    from tallyloom.sinks import landing

    plain = landing._write_lines

    def write_and_let_the_file_grow(spark, paths, glob, data):
        plain(spark, paths, glob, data)
        (tmp_path / "one/a.csv").write_bytes(b"x\nmore than before\n")

    monkeypatch.setattr(landing, "_write_lines", write_and_let_the_file_grow)
    with pytest.raises(Exception, match="a.csv is not what was landed"):
        land_exact(spark, str(tmp_path / "one"), target)
    assert landings(spark, target) == []
    monkeypatch.undo()
    assert land_exact(spark, str(tmp_path / "one"), target) == "0000000002"
    assert hashes(spark, target) == {"a.csv": sha(b"x\nmore than before\n")}


def test_csv_rows(spark, tmp_path, small_splits):
    rows = [f'"a ""{i}"", b",K{i}' for i in range(4_000)] + ["", "sport,noc", ",x"]
    put(tmp_path, "f.csv", ("sport,noc\n" + "\n".join(rows) + "\n").encode())
    put(tmp_path, "g.csv", b"\xef\xbb\xbfsport,noc\r\n1,2\r\n3,\r\n")
    put(tmp_path, "h.csv", b"sport,noc")
    target = str(tmp_path / "raw")
    land_exact(spark, str(tmp_path / "in"), target)
    got = read_landing_csv(spark, target, ["sport", "noc"])
    assert got.columns == ["sport", "noc", "landing", "file_name"]
    f = [(r["sport"], r["noc"]) for r in got.where("file_name = 'f.csv'").collect()]
    want = [(f'a "{i}", b', f"K{i}") for i in range(4_000)] + [("sport", "noc"), (None, "x")]
    assert sorted(f, key=str) == sorted(want, key=str)
    g = sorted((r["sport"], r["noc"]) for r in got.where("file_name = 'g.csv'").collect())
    assert g == [("1", "2"), ("3", None)]
    assert got.where("file_name = 'h.csv'").collect() == []
    assert read_landing_csv(spark, target, ["sport", "noc"], header=False).count() == got.count() + 3

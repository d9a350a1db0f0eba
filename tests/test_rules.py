"""What holds for the whole package and for every registered plan."""

import pathlib
import re

import pytest

import __spark_entry__ as registry

ROOT = pathlib.Path(registry.__file__).parent
SF_DIR = "/root/testdata/sf0.001"
CORE = sorted(p for p in ROOT.glob("tallyloom/**/*.py") if "llm" not in p.parts)
BANNED = re.compile(
    r"\.rdd\b|toPandas|localCheckpoint|\budf\b|pandas_udf|InPandas|mapPartitions|\.crossJoin"
    r"|\.sample\(|coalesce\(1\)|\.master\("
)


@pytest.mark.parametrize("path", CORE, ids=lambda p: p.name)
def test_sources_stay_on_the_executors(path):
    assert not BANNED.search(path.read_text())


@pytest.mark.parametrize("name", sorted(registry.core_queries()))
def test_plans_have_no_pairs_and_no_python(spark, name):
    plan = registry.core_queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert node not in plan


@pytest.mark.parametrize(
    "name, columns",
    [
        ("tally", ["l_suppkey", "l_linenumber", "l_returnflag", "s_suppkey"]),
        ("tally_large_dim", ["l_orderkey", "l_linenumber", "l_returnflag", "o_orderkey"]),
        ("tally_null_outcome", ["user_id", "event_type", "c_custkey", "c_mktsegment"]),
        ("tally_null_group", ["o_orderstatus", "o_orderpriority"]),
        ("latest_per_key_nulls", ["event_id", "user_id", "event_type"]),
        ("dq_row_count", []),
        ("dq_null_key", ["o_orderstatus"]),
        ("shifted_time", ["event_id", "ts"]),
        ("text_preview", ["doc_id", "text"]),
        ("path_basename", ["page_id", "url"]),
    ],
)
def test_scans_read_only_the_columns_used(spark, name, columns):
    plan = registry.core_queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    read = re.findall(r"FileScan parquet \[(.*?)\]", plan)
    assert {c.split("#")[0] for scan in read for c in scan.split(",") if c} == set(columns)

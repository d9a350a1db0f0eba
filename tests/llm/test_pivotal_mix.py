"""Targets against the rule spelled out; the rounding by what it promises."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import pivotal_mix
from tallyloom.llm.pivotal_mix import mix_documents, mixing_plan, source_targets
from tallyloom.llm.queries import op11_pivotal_mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """``sizes``: words by source; the excess of full sources is shared out again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, total = set(), share * sum(sizes.values())
    while True:
        rest = [s for s in order if s not in full]
        left = total - sum(most * sizes[s] for s in full)
        heavy = sum(weight[s] for s in rest)
        target = {s: most * sizes[s] if s in full else left * weight[s] / heavy for s in order}
        above = {s for s in rest if target[s] > most * sizes[s]}
        if not above:
            return target
        full |= above


@pytest.mark.parametrize("seed", range(4))
def test_targets(llm, seed):
    rng = random.Random(seed)
    sizes = {f"s{k}é" * (k % 2) + f"{k}": rng.choice([0, 3, 50, 4000]) for k in range(37)} | {None: 70, "": 9}
    sources = llm.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in source_targets(sources).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def check(rows, texts, sources):
    """A plan's rows against the sizes and targets of (text, source) pairs."""
    sizes = [len(WORD.findall(t or "")) for t in texts]
    total = Counter()
    for size, source in zip(sizes, sources, strict=True):
        total[source] += size
    target, taken, largest = brute_targets(dict(total)), Counter(), defaultdict(int)
    assert sorted(r["size"] for r in rows) == sorted(sizes)
    for r in rows:
        assert r["taken"] == r["size"] * r["copies"] and 0 <= r["copies"] <= 2
        assert r["source_size"] == total[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for source in total:
        assert abs(taken[source] - target[source]) <= largest[source] + 1e-6
    return taken, target


def test_query_on_the_table(llm):
    sf_dir = "/root/testdata/sf0.01"
    docs = llm.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source").collect()
    plan = op11_pivotal_mixing(llm, sf_dir)
    rows = plan.collect()
    assert {r["doc_id"] for r in rows} == {d["doc_id"] for d in docs}
    check(rows, [d["text"] for d in docs], [d["source"] for d in docs])
    assert Counter(map(tuple, op11_pivotal_mixing(llm, sf_dir).collect())) == Counter(map(tuple, rows))


@pytest.mark.parametrize("arity", [4, 512])
def test_trees_of_any_depth_and_reruns(llm, documents, monkeypatch, arity):
    monkeypatch.setattr(pivotal_mix, "ARITY", arity)
    rng = random.Random(arity)
    texts = ["w " * rng.choice([1, 5, 9, 30] * 10 + [400]) for _ in range(600)]  # 400 is long here
    sources = ["hot" if k % 3 else f"s{k % 5}" for k in range(600)]
    docs = documents(texts).withColumn(
        "source", F.when(F.col("doc_id") % 3 != 0, "hot").otherwise(F.concat(F.lit("s"), F.col("doc_id") % 5))
    )
    rows = mixing_plan(docs).collect()
    taken, target = check(rows, texts, sources)
    assert abs(taken["hot"] - target["hot"]) <= 30  # the last residual is a short document
    again = mixing_plan(docs.repartition(7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))
    other = mixing_plan(docs, seed=1).collect()
    assert Counter(map(tuple, other)) != Counter(map(tuple, rows))


def test_every_document_keeps_its_probability(llm, monkeypatch):
    """Equal sources are repetitions: over them each document is taken ``share`` times on average."""
    monkeypatch.setattr(pivotal_mix, "ARITY", 4)
    sizes, n = [1, 2, 3, 5, 8, 13, 21, 34, 55, 300], 600
    rows = [(d, "w " * s, f"s{k}") for k in range(n) for d, s in enumerate(sizes)]
    docs = llm.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing_plan(docs, weights=(1,), share=0.7)
    for r in plan.groupBy("doc_id").agg(F.sum("copies").alias("c")).collect():
        assert abs(r["c"] / n - 0.7) < 0.09
    off = plan.groupBy("source").agg(F.max(F.lit(0.0)), F.sum("taken") - F.max("target")).collect()
    assert max(abs(r[2]) for r in off) <= 300


def test_edges(llm, documents, monkeypatch):
    monkeypatch.setattr(pivotal_mix, "ROWS", 64)
    monkeypatch.setattr(pivotal_mix, "ARITY", 8)
    schema = "doc_id long, text string, source string"
    assert mixing_plan(llm.createDataFrame([], schema)).collect() == []
    assert mix_documents(llm.createDataFrame([], schema)).collect() == []
    rows = [(1, None, "a"), (2, "", "a"), (3, " \t", None), (None, "x y z", None)]
    rows += [(None, "x y z", "b")] * 900 + [(7, "w " * 9, "b")] * 5 + [(8, "long " * 20_000, "c")]
    docs = llm.createDataFrame(rows, schema).selectExpr(
        "*", "1 as size", "2 as target", "3 as base", "4 as `a.b`", "5 as n", "6 as key", "7 as k", "8 as h"
    )
    plan = mixing_plan(docs.repartition(5)).collect()
    check(plan, [r[1] for r in rows], [r[2] for r in rows])
    assert all(r["taken"] == 0 for r in plan if r["size"] == 0)
    mixed = mix_documents(docs)
    assert mixed.columns == [*docs.columns, "copies"]
    got = Counter((r["doc_id"], r["source"], r["text"], r["copies"]) for r in mixed.collect())
    text = {(r[0], r[2], len((r[1] or "").split())): r[1] for r in rows if (r[1] or "").split()}
    want = Counter(
        (r["doc_id"], r["source"], text[r["doc_id"], r["source"], r["size"]], r["copies"])
        for r in plan
        if r["copies"]
    )
    assert got == want
    with pytest.raises(ValueError, match="copies"):
        mix_documents(docs.withColumn("Copies", F.lit(1)))


def test_all_texts_empty(llm):
    docs = llm.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r["target"], r["taken"]) for r in mixing_plan(docs).collect()] == [(0.0, 0), (0.0, 0)]


def test_no_python_in_the_plan(llm, capsys):
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet")
    mix_documents(docs).explain()
    shown = capsys.readouterr().out
    assert "Python" not in shown and "Arrow" not in shown

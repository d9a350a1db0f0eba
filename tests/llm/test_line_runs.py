"""Repeated runs of lines against a scan of all pairs of worded lines."""

import hashlib
import random

import pytest

from tallyloom.llm.line_chunks import dedup_line_runs
from tallyloom.llm.queries import QUERIES


def brute(docs):
    """``docs``: (id, text), one row per id; (lines, removed lines, removed runs, text)."""
    seen, out = set(), {}
    for i, text in sorted(docs):
        if text is None:
            out[i] = (0, 0, 0, None)
            continue
        lines = text.split("\n")
        gone = [False] * len(lines)
        worded = [k for k, line in enumerate(lines) if line.strip(" ") != ""]
        for a, b in zip(worded, worded[1:], strict=False):
            pair = tuple(lines[a : b + 1])
            if pair in seen:
                gone[a : b + 1] = [True] * (b + 1 - a)
            seen.add(pair)
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        kept = "\n".join(line for line, g in zip(lines, gone, strict=True) if not g)
        out[i] = (len(lines), sum(gone), runs, kept)
    return out


def rows(df):
    return {r["doc_id"]: (r["n_lines"], r["n_removed_lines"], r["n_removed_runs"], r["text"]) for r in df.collect()}


@pytest.mark.parametrize("n", [2, 3, 4, 5, 6])
def test_planted_passages_go_whole(documents, n):
    passage = [f"shared {n} {k}" for k in range(n)]
    texts = []
    for d in range(40):
        own = [f"own {n} {d} {k}" for k in range(4)]
        texts.append("\n".join(own[:2] + passage + own[2:]))
    got = rows(dedup_line_runs(documents(texts)))
    assert got[0] == (n + 4, 0, 0, texts[0])
    for d in range(1, 40):
        assert got[d] == (n + 4, n, 1, "\n".join(f"own {n} {d} {k}" for k in range(4)))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_the_rule(documents, seed):
    rng = random.Random(seed)
    lines = [f"line {i} é" for i in range(60)] + ["", " "] * 8
    passages = [rng.choices(lines, k=rng.randrange(2, 9)) for _ in range(5)]
    texts = []
    for _ in range(80):
        own = rng.choices(lines, k=rng.randrange(6))
        for _ in range(rng.randrange(1, 4)):
            own += rng.choice(passages) + rng.choices(lines, k=rng.randrange(3))
        texts.append("\n".join(own))
    texts += [texts[0], None, "", "\n", "one", "a\na\na\na"]
    got = rows(dedup_line_runs(documents(texts)))
    assert got == brute(list(enumerate(texts)))


def test_rows_of_one_id(documents):
    text = "\n".join(f"row {i}" for i in range(30))
    got = dedup_line_runs(documents([(1, text), (1, text), (None, text), (9, text)])).collect()
    removed = sorted((str(r["doc_id"]), r["n_removed_lines"]) for r in got)
    assert removed == [("1", 0), ("1", 0), ("9", 30), ("None", 30)]
    assert dedup_line_runs(documents([])).collect() == []


def test_query_on_the_table(llm):
    sf_dir = "/root/testdata/sf0.01"
    docs = llm.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = {
        i: (*w[:3], hashlib.sha256(w[3].encode()).hexdigest())
        for i, w in brute([tuple(d) for d in docs]).items()
    }
    got = {
        r["doc_id"]: (r["n_lines"], r["n_removed_lines"], r["n_removed_runs"], r["kept_sha256"])
        for r in QUERIES["op6_line_run_dedup"](llm, sf_dir).collect()
    }
    assert got == want

"""Line chunks against the same rule spelled out in Python."""

import hashlib
import random

import pytest

from tallyloom.llm.line_chunks import dedup_lines
from tallyloom.llm.queries import op6_line_chunk_dedup


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def chunks(text):
    lines, out, start, before = text.split("\n"), [], 0, ""
    for i, line in enumerate(lines):
        own = md5(line)
        if md5(before + own)[0] in "01234" or i == len(lines) - 1:
            out.append(lines[start : i + 1])
            start = i + 1
        before = own
    return out


def brute(docs):
    """``docs``: (id, text), one row per id; (lines, removed lines, removed chunks, text)."""
    seen, out = set(), {}
    for i, text in sorted(docs):
        if text is None:
            out[i] = (0, 0, 0, None)
            continue
        kept, lines, gone = [], 0, 0
        for chunk in chunks(text):
            worded = sum(line.strip(" ") != "" for line in chunk) >= 2
            if worded and tuple(chunk) in seen:
                lines, gone = lines + len(chunk), gone + 1
            else:
                kept += chunk
                if worded:
                    seen.add(tuple(chunk))
        out[i] = (text.count("\n") + 1, lines, gone, "\n".join(kept) if gone else text)
    return out


def rows(df):
    return {
        r["doc_id"]: (r["n_lines"], r["n_removed_lines"], r["n_removed_chunks"], r["text"])
        for r in df.collect()
    }


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_the_rule(documents, seed):
    rng = random.Random(seed)
    lines = [f"line {i} é" for i in range(60)] + ["", " "]
    passages = [rng.choices(lines, k=12) for _ in range(5)]
    texts = []
    for _ in range(80):
        own = rng.choices(lines, k=rng.randrange(6))
        for _ in range(rng.randrange(1, 4)):
            own += rng.choice(passages)[rng.randrange(4) :] + rng.choices(lines, k=rng.randrange(3))
        texts.append("\n".join(own))
    texts += [texts[0], None, "", "\n", "one"]
    got = rows(dedup_lines(documents(texts)))
    assert got == brute(list(enumerate(texts)))
    assert sum(g[1] for g in got.values()) > 100


def test_rows_of_one_id_and_extra_columns(documents):
    text = "\n".join(f"row {i}" for i in range(30))
    docs = documents([(1, text), (1, text), (None, text), (9, text)])
    docs = docs.selectExpr("*", "7 as n_lines", "8 as lines", "9 as pos", "'x' as hash", "1 as `a.b`")
    got = dedup_lines(docs)
    assert got.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    removed = sorted((str(r["doc_id"]), r["n_removed_lines"] > 20) for r in got.collect())
    assert removed == [("1", False), ("1", False), ("9", True), ("None", True)]
    assert dedup_lines(documents([])).collect() == []


def test_long_text_of_repeats(documents):
    text = "\n".join(f"row {i % 9000}" for i in range(40_000))
    got = rows(dedup_lines(documents([(2, text), (5, text)])))
    assert got == brute([(2, text), (5, text)])


def test_query_on_the_table(llm):
    sf_dir = "/root/testdata/sf0.01"
    docs = llm.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = {
        i: (*w[:3], hashlib.sha256(w[3].encode()).hexdigest())
        for i, w in brute([tuple(d) for d in docs]).items()
    }
    got = {
        r["doc_id"]: (r["n_lines"], r["n_removed_lines"], r["n_removed_chunks"], r["kept_sha256"])
        for r in op6_line_chunk_dedup(llm, sf_dir).collect()
    }
    assert got == want

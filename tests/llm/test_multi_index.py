"""Hard negatives against a scan of all rows for every anchor."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import multi_index
from tallyloom.llm.multi_index import Books, _Best, _Piece, _Window, build_index, hard_negatives
from tallyloom.llm.queries import op12_multi_index_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, is_anchor, positives=5, negatives=3, low=50, high=95):
    good = set()
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [math.floor(256 * x) for x in v]
        good.add((i, label, tuple(whole)))
    out = []
    for i, label, v in good:
        if not is_anchor(i):
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(v, w)), j, other)  # noqa: B905
            for j, other, w in good
            if j != i
        )
        for score, j, _ in [s for s in scored if s[2] == label][:positives]:
            ps, rank = -score, 0
            for s, k, other in scored:
                if other != label and low * ps <= -100 * s <= high * ps and rank < negatives:
                    rank += 1
                    out.append((i, j, rank, k, ps, -s))
    return sorted(out)


def clusters(seed, n=400, width=12, spread=0.2):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(12)]
    rows = []
    for i in range(n):
        v = [float(np.float32(x + rng.gauss(0, spread))) for x in rng.choice(centres)]
        rows.append((i, v, rng.randrange(3)))
    return rows


@pytest.mark.parametrize("seed, spread, block", [(1, 0.2, 8 << 20), (2, 3.0, 900), (3, 0.0, 400)])
def test_matches_all_pairs(llm, monkeypatch, seed, spread, block):
    monkeypatch.setattr(multi_index, "PIECE_BYTES", 4_000)
    rows = clusters(seed, spread=spread)
    got = hard_negatives(
        llm.createDataFrame(rows, SCHEMA).repartition(3),
        F.col("vec_id") % 37 == 0,
        codes=5,
        sample=100,
        block_bytes=block,
    )
    want = brute(rows, lambda i: i % 37 == 0)
    assert want
    assert sorted(map(tuple, got.collect())) == want


def test_edges(llm):
    rows = clusters(5, n=60, width=5)
    rows += [(100, None, 1), (101, [1.0, None, 0.0], 1), (102, [float("nan")] * 5, 1), (103, [float("inf")] * 5, 2)]
    rows += [(None, [1.0] * 5, 1), (104, [1.0] * 5, None), (105, [1.0, 2.0], 1), (106, [], 0)]
    rows += rows[:7] + [(0, [0.5] * 5, 2)]
    frame = llm.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as id", "2 as v", "3 as cell", "4 as `a.b`")
    got = hard_negatives(frame, F.col("vec_id") % 5 == 0)
    assert sorted(map(tuple, got.collect())) == brute(rows, lambda i: i % 5 == 0)
    empty = llm.createDataFrame([], SCHEMA)
    assert hard_negatives(empty, F.col("vec_id") % 5 == 0).collect() == []
    assert hard_negatives(frame, F.col("vec_id") < 0).collect() == []
    assert hard_negatives(frame, F.col("vec_id") % 5 == 0).columns == got.columns


@pytest.mark.parametrize("size", [3_000.0, 1e8, 3e14])
def test_large_components_are_exact(llm, size):
    rng = random.Random(4)
    rows = [(i, [rng.random() * size for _ in range(4)], i % 2) for i in range(40)]
    frame = llm.createDataFrame(rows, SCHEMA.replace("float", "double"))
    want = brute(rows, lambda i: i % 10 == 0)
    top = (1 << 63) - 1
    want = [(*w[:4], min(w[4], top), min(w[5], top)) for w in want]
    got = sorted(map(tuple, hard_negatives(frame, F.col("vec_id") % 10 == 0).collect()))
    if max(w[4] for w in want) < top:
        assert got == want
    else:  # beyond 64 bits a score is the largest long
        assert {g[0] for g in got} <= {w[0] for w in want}


def test_query_on_the_table(llm):
    sf_dir = "/root/testdata/sf0.01"
    rows = llm.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    moved = [(i, v, (k + 1) % 10 if i % 7 == 0 else k) for i, v, k in map(tuple, rows)]
    got = op12_multi_index_negatives(llm, sf_dir)
    assert sorted(map(tuple, got.collect())) == brute(moved, lambda i: i % 50 == 0)


def piece(rows, codes):
    ids, vectors, labels = zip(*rows, strict=True)
    x = np.floor(256 * np.array(vectors, np.float32).astype(np.float64))
    books = Books(x, codes)
    cells = np.zeros(len(x), np.int64)
    for half, (part, book) in enumerate(zip(books.halves(x), books.codes, strict=True)):
        code = multi_index._nearest(part, book)
        np.maximum.at(books.radii[half], code, np.sqrt(((part - book[code]) ** 2).sum(1)))
        cells = cells * len(book) + code
    table = pa.table(
        {"id": list(ids), "label": list(labels), "v": x.astype(np.int64).tolist(), "cell": cells.astype(np.int32)}
    )
    return _Piece(table, books), x


def test_stops_early_where_cells_are_tight(monkeypatch):
    """Cells are visited from the highest bound down, each once, and most are never opened."""
    monkeypatch.setattr(multi_index, "BATCH", 1)
    rows = clusters(8, n=2_000, width=8, spread=0.05)
    found, x = piece(rows, 12)
    scored = []
    plain = found._score
    found._score = lambda spans, *rest: (scored.extend(spans), plain(spans, *rest))
    for aims in (_Best(0, 5), _Window([(10_000, 60_000), (5, 4)], 3)):
        scored.clear()
        found.visit(0, rows[0][2], x[0], aims)
        assert len(scored) == len(set(scored))
        assert 0 < sum(b - a for a, b in scored) < 1_000
    scored.clear()
    found.visit(0, rows[0][2], x[0], _Window([], 3))
    assert scored == []


def test_index_holds_every_row(llm):
    rows = clusters(9)
    index, books = build_index(llm.createDataFrame(rows, SCHEMA), "vec_id", "embedding", "label", sample=50)
    assert {r["id"] for r in index.collect()} == set(range(400))
    assert max(books.radii[0]) == pytest.approx(index.agg(F.max("r1")).first()[0])

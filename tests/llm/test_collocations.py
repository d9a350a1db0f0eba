"""Phrases against plain counts of all of them."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from tallyloom.llm import collocations as module
from tallyloom.llm.collocations import collocations, dictionary
from tallyloom.llm.queries import op13_collocations

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, least=30, top=2000, inside=80):
    counts = defaultdict(Counter)
    for text, lang in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts["und" if lang is None else lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longer = defaultdict(int)
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i : i + k]] = max(longer[p[i : i + k]], a)
        rows = []
        for p, a in candidates.items():
            if 100 * longer[p] >= inside * a:
                continue
            score, _, l, r = min(  # noqa: E741
                (2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))
            )
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1):  # noqa: E741
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def corpus(seed, n=150):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(25)] + ["Ä", "ä", "É", "THE", "the", "x y"]
    passages = [rng.choices(words, k=rng.randrange(3, 40)) for _ in range(6)]
    docs = []
    for _ in range(n):
        own = []
        for _ in range(rng.randrange(4)):
            own += rng.choice(passages) + rng.choices(words, k=rng.randrange(6))
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "\x0b", "! "]) for w in own)
        docs.append((text, rng.choice(["en", "en", "de", None, "und"])))
    return docs


def frame(llm, docs):
    rows = [(i, t, lang) for i, (t, lang) in enumerate(docs)]
    return llm.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)


@pytest.mark.parametrize("seed, least, top", [(1, 3, 2000), (2, 8, 7), (3, 1, 40)])
def test_matches_plain_counts(llm, seed, least, top):
    docs = corpus(seed)
    got = collocations(frame(llm, docs), least=least, top=top)
    want = brute(docs, least, top)
    assert len(want) > 20
    assert sorted(map(tuple, got.collect())) == want


def test_full_bit_array_changes_nothing(llm, monkeypatch):
    """With one bit for many hashes more phrases are counted, and the same returned."""
    monkeypatch.setattr(module, "BITS", 6)
    docs = corpus(4)
    got = collocations(frame(llm, docs), least=4)
    assert sorted(map(tuple, got.collect())) == brute(docs, 4)


def test_edges(llm):
    docs = [(None, "en"), ("", None), (" \t", "en"), ("...", "en"), ("one", "fr"), ("A b. a B", "fr")]
    docs += [("a b c", "fr")] * 3 + [("same " * 5_000, "en"), ("l" * 100_000 + " end", "en")]
    docs += [("".join(f"n{i} " for i in range(3_000)) * 2, "de")]
    rows = frame(llm, docs).selectExpr("*", "1 as n", "2 as h", "3 as freq", "4 as `a.b`", "5 as phrase")
    got = collocations(rows, least=2, top=50)
    assert sorted(map(tuple, got.collect())) == brute(docs, 2, 50)
    assert collocations(frame(llm, []), least=2).collect() == []
    assert collocations(frame(llm, [(None, None)]), least=2).collect() == []


def test_repeated_passages_are_one_entry(llm):
    rng = random.Random(6)
    passage = " ".join(f"p{rng.randrange(500)}" for _ in range(400))
    docs = [(f"own {k} {' '.join(f'x{k}y{i}' for i in range(rng.randrange(30)))} {passage}", "en") for k in range(50)]
    entries = dictionary(frame(llm, docs)).collect()
    words = sum(len(t.split()) for t, _ in docs)
    assert sum(e["own"] * e["freq"] for e in entries) == words
    assert sum(e["own"] for e in entries) < words / 5
    assert max(e["freq"] for e in entries) == 50


def test_rare_phrases_are_not_written(llm, monkeypatch):
    """Counts under the bound end in the task that adds them up."""
    written = []
    original = module.materialize

    def recorded(df, name):
        table = original(df, name)
        if "a" in table.columns:
            written.append((name, table.count(), table.where("a < 5").count()))
        return table

    monkeypatch.setattr(module, "materialize", recorded)
    docs = corpus(7)
    got = collocations(frame(llm, docs), least=5)
    assert sorted(map(tuple, got.collect())) == brute(docs, 5)
    assert sum(n for _, n, _ in written) > 100
    assert [rare for _, _, rare in written if rare] == []


def test_many_ranges_of_hashes(llm, monkeypatch):
    monkeypatch.setattr(module, "GROUP", 40)
    docs = corpus(8)
    got = collocations(frame(llm, docs), least=4)
    assert sorted(map(tuple, got.collect())) == brute(docs, 4)


@pytest.mark.parametrize("block, held", [(1, 30), (1, 1 << 20), (1 << 20, 1)])
def test_counts_packed_part_by_part(llm, monkeypatch, block, held):
    """Rows of a task are one for each range and language, however often it hands them on."""
    monkeypatch.setattr(module, "BLOCK", block)
    monkeypatch.setattr(module, "HELD", held)
    monkeypatch.setattr(module, "HELD_TEXTS", held * 20)
    docs = corpus(9)
    want = Counter()
    for text, lang in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text.translate(FOLD)):
            words = re.findall(r"[^\x20\x09]+", piece)
            want.update(("und" if lang is None else lang, " ".join(p)) for p in zip(words, words[1:], strict=False))
    want = {p: a for p, a in want.items() if a >= 3}
    every = np.full(1 << 10, -1, np.int64).view(np.uint64)
    entries = dictionary(frame(llm, docs)).toArrow().to_batches(max_chunksize=50)
    packed = pa.Table.from_batches(module._counter(3, every, 7)(iter(entries)))
    if held == 1 << 20:
        assert len(packed) <= 7 * 4
    got, hashes = {}, set()
    for part in range(7):
        rows = module._adder(3)(packed.filter(pc.equal(packed["part"], part))).to_pylist()
        got |= {(r["lang"], r["phrase"]): r["a"] for r in rows if r["phrase"] is not None}
        hashes |= {r["h"] for r in rows if r["phrase"] is None}
        assert all(r["a"] >= 3 for r in rows)
    assert got == want
    assert len(hashes) > 20


def test_query_on_the_table(llm):
    sf_dir = "/root/testdata/sf0.01"
    docs = [(r["text"], r["lang"]) for r in llm.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(map(tuple, op13_collocations(llm, sf_dir).collect())) == brute(docs)

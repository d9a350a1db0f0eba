"""The n-gram join against all pairs, on small sets and on the given table."""

import random
import re
from collections import Counter, defaultdict

import pytest

from tallyloom.llm import ngram_trie
from tallyloom.llm.ngram_trie import keep_one_of_each, near_duplicates
from tallyloom.llm.queries import op2_ngram_trie_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORD.findall((text or "").translate(FOLD))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def brute(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    holders, up = defaultdict(list), {i: i for i in texts}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in sorted(sets):
        common = Counter(j for s in sets[i] for j in holders[s])
        for j, n in common.items():
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
        for s in sets[i]:
            holders[s].append(i)
    return {i: (len(sets[i]), find(i)) for i in sets}


def rows(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def corpus(seed, n=160):
    """Families of edited copies around one another, some exact, and a common passage."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = rng.choices(words, k=30)
    texts = []
    for _ in range(n // 8):
        base = rng.choices(words, k=rng.choice([6, 12, 40, 120]))
        if rng.random() < 0.5:
            base += passage
        for _ in range(8):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
                own[rng.randrange(len(own))] = rng.choice(words)
            if rng.random() < 0.3:
                own = own[: max(1, len(own) - rng.randrange(len(own) // 3 + 1))]
            texts.append(rng.choice([" ", "\n", " \t "]).join(own))
    return texts


@pytest.mark.parametrize("seed, group_bytes", [(1, 8 << 20), (2, 2_000), (3, 500)])
def test_matches_all_pairs(documents, seed, group_bytes):
    texts = corpus(seed)
    got = rows(near_duplicates(documents(texts), group_bytes=group_bytes))
    assert got == brute(dict(enumerate(texts)))


@pytest.mark.parametrize("step, pivots", [(1, 16), (3, 1)])
def test_large_components(documents, monkeypatch, step, pivots):
    """A window that moves on links neighbours only; copies of one text link all around it."""
    monkeypatch.setattr(ngram_trie, "PIVOTS", pivots)
    rng = random.Random(step)
    chain = [f"c{i}" for i in range(400)]
    texts = [" ".join(chain[k : k + 60]) for k in range(0, 300, step)]
    base = [f"b{i}" for i in range(100)]
    for k in range(60):
        own = list(base)
        for _ in range(k % 4):
            own[rng.randrange(100)] = f"e{k}"
        texts.append(" ".join(own))
    rng.shuffle(texts)
    got = rows(near_duplicates(documents(texts), group_bytes=20_000))
    assert got == brute(dict(enumerate(texts)))
    assert max(Counter(c for _, c in got.values()).values()) >= 100


def test_many_parts(documents, monkeypatch):
    monkeypatch.setattr(ngram_trie, "HASHES", 64)
    texts = corpus(5)
    assert rows(near_duplicates(documents(texts))) == brute(dict(enumerate(texts)))


def test_edges(documents):
    long = " ".join(f"v{i % 9_000}" for i in range(30_000))
    texts = [
        (5, None),
        (6, ""),
        (7, " \t\n"),
        (8, "One two"),
        (9, "one  TWO"),
        (10, "one two three"),
        (11, "é b c d e f"),
        (12, "É b c d e f"),
        (13, "one\x1ctwo"),
        (3, long),
        (14, long + " tail"),
    ]
    want = {5: (0, 5), 6: (0, 6), 7: (0, 7), 8: (1, 8), 9: (1, 8), 10: (1, 10)}
    want |= {11: (2, 11), 12: (2, 12), 13: (1, 13), 3: (9_000, 3), 14: (9_001, 3)}
    assert rows(near_duplicates(documents(texts))) == want
    assert near_duplicates(documents([])).collect() == []


def test_repeated_rows_and_missing_ids(documents):
    text = "a b c d e f g h"
    docs = documents([(4, text), (4, text), (None, text), (4, "other words of this row here"), (2, text)])
    got = sorted((str(r["doc_id"]), r["component_id"]) for r in near_duplicates(docs).collect())
    assert got == [("2", 2), ("4", 2), ("4", 2), ("4", 4), ("None", 2)]
    alone = near_duplicates(documents([(None, "x y"), (None, "x y")])).collect()
    assert [r["component_id"] for r in alone] == [None, None]


def test_one_of_each_stays(documents):
    text = "a b c d e f g h"
    docs = documents([(4, text), (4, text), (2, text), (2, text), (7, "x y"), (8, ""), (9, None), (1, "z")])
    kept = keep_one_of_each(docs.selectExpr("*", "1 as sid", "2 as hash"))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 7, 8, 9]
    assert kept.columns == [*docs.columns, "sid", "hash"]


def test_query_on_the_table(llm):
    sf_dir = "/root/testdata/sf0.01"
    texts = {r[0]: r[1] for r in llm.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    assert rows(op2_ngram_trie_join(llm, sf_dir)) == brute(texts)


@pytest.mark.parametrize("text", ["one two three four five six", "word"])
def test_a_repeated_row_leaves_rows_without_words(documents, text):
    bare = [(2, " "), (2, " "), (3, "\n\t"), (None, ""), (None, ""), (None, None), (None, None)]
    for repeated in ([], [(1, text), (1, text)]):
        kept = [(r["doc_id"], r["text"]) for r in keep_one_of_each(documents([*bare, *repeated])).collect()]
        assert sorted(map(str, kept)) == sorted(map(str, [*bare, *repeated[:1]]))

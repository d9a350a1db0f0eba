"""Removal of repeated strings against a scan of all strings."""

import hashlib
import random

import pytest

from tallyloom.llm import prefix_free
from tallyloom.llm.prefix_free import remove_repeats
from tallyloom.llm.queries import op4_prefix_free_dedup


def brute(docs, length=100):
    """``docs``: (id, text), one row per id."""
    seen, out = set(), {}
    for i, text in sorted(docs):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            string = raw[s : s + length]
            if string in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(string)
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def rows(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()}


def corpus(seed):
    rng = random.Random(seed)
    letters = rng.choice(["ab", "abcdefghij é", "xy\x00"])
    passages = ["".join(rng.choices(letters, k=rng.randrange(90, 400))) for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            passage = rng.choice(passages)
            low = rng.randrange(40)
            parts.append("".join(rng.choices(letters, k=rng.randrange(60))) + passage[low:])
        texts.append("".join(parts))
    return [*texts, texts[0], "a" * 700, "ab" * 300, "", None, "short"]


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
@pytest.mark.parametrize("options", [{}, {"salt_docs": 7, "phrases": 16}], ids=["one", "salted"])
def test_matches_all_strings(documents, seed, options):
    texts = corpus(seed)
    assert rows(remove_repeats(documents(texts), **options)) == brute(list(enumerate(texts)))


def test_kept_bytes_and_spans(documents):
    passage = "".join(random.Random(5).choices("abcdefgh", k=150))
    got = {r["doc_id"]: r for r in remove_repeats(documents([passage, "é" + passage + "."]), texts=True).collect()}
    assert (got[1]["kept"], got[1]["spans"]) == ("é.".encode(), "2:152")
    assert got[0]["spans"] == ""


def test_rows_of_one_id_are_one_document(documents):
    text = "".join(random.Random(6).choices("abcdefgh", k=300))
    got = remove_repeats(documents([(1, text), (1, text), (None, text), (3, text)])).collect()
    assert sorted((str(r["doc_id"]), r["n_removed"]) for r in got) == [("1", 0), ("1", 0), ("3", 300), ("None", 300)]
    assert remove_repeats(documents([])).collect() == []


def test_query_on_the_table(llm):
    sf_dir = "/root/testdata/sf0.01"
    docs = llm.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert rows(op4_prefix_free_dedup(llm, sf_dir)) == brute([tuple(d) for d in docs])


@pytest.mark.parametrize("options", [{}, {"salt_docs": 40, "phrases": 64}], ids=["one", "salted"])
def test_borders_of_a_passage_in_all_documents_are_split(documents, monkeypatch, options):
    rng = random.Random(7)
    passage = "".join(rng.choices("abcdefgh", k=260))
    texts = ["".join(rng.choices("ijklmnop", k=130)) for _ in range(400)]
    docs = [(i, t[:65] + passage + t[65:]) for i, t in enumerate(texts)]
    docs += [docs[5], docs[5], (400, docs[5][1][3:300] + "z" * 90)]
    largest = {"strings": 30_000, "phrases": 300}

    def bounded_strings(*args):
        run = real_strings(*args)

        def bounded(table):
            size = sum(len(x) for x in table.column("bytes").to_pylist())
            assert size <= largest["strings"], size
            return run(table)

        return bounded

    def bounded_phrases(parts, owners, last, *more):
        run = real_phrases(parts, owners, last, *more)

        def bounded(table):
            size = sum(len(x) // 4 for x in table.column("s").to_pylist())
            assert not last or owners == parts or size <= largest["phrases"], size
            return run(table)

        return bounded

    real_strings, real_phrases = prefix_free._compare_strings, prefix_free._compare_phrases
    monkeypatch.setattr(prefix_free.remove_repeats, "__defaults__", tuple(
        8 if d == 1 << 14 else d for d in prefix_free.remove_repeats.__defaults__
    ))
    monkeypatch.setattr(prefix_free, "BYTES", 8_000)
    monkeypatch.setattr(prefix_free, "_compare_strings", bounded_strings)
    monkeypatch.setattr(prefix_free, "_compare_phrases", bounded_phrases)
    got = rows(remove_repeats(documents(docs, partitions=12), **options))
    assert got == brute(sorted(set(docs)))

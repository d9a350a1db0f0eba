"""Contamination against all alignments of all items."""

import random
import re

from tallyloom.llm.queries import op8_spaced_seed_contamination
from tallyloom.llm.spaced_seeds import contamination, decontaminate

WORD = re.compile(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def contained(doc, item, share=0.8, window=20):
    """Whether a window of the item agrees with the text at any alignment."""
    width = min(window, len(item))
    for shift in range(-len(item) + 1, len(doc)):
        same = [0 <= k + shift < len(doc) and item[k] == doc[k + shift] for k in range(len(item))]
        low, high = max(0, -shift), min(len(item), len(doc) - shift)
        for k in range(low, high - width + 1):
            if width and sum(same[k : k + width]) >= share * width:
                return True
    return False


def items(llm, rows):
    return llm.createDataFrame(rows, "item_id long, text string")


def found(df):
    return {r["doc_id"]: r["item_ids"] for r in df.collect()}


def test_substitutions_punctuation_and_case(llm, documents):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(300)]
    own = [rng.choices(vocabulary, k=n) for n in (40, 25, 20, 12)] + [["just", "four", "short", "words"]]
    bench = items(llm, [(10 + k, " ".join(w)) for k, w in enumerate(own)] + [(90, None), (None, "w1 w2"), (91, "")])
    texts = []
    for _ in range(120):
        text = rng.choices(vocabulary, k=rng.randrange(60))
        if rng.random() < 0.7:
            part = list(rng.choice(own))
            for _ in range(rng.randrange(4)):
                part[rng.randrange(len(part))] = "other"
            text = text[: len(text) // 2] + part + text[len(text) // 2 :]
        texts.append(rng.choice([" ", ", ", "\n"]).join(w.upper() if rng.random() < 0.3 else w for w in text))
    texts += [None, "", "Just FOUR, short; words!"]
    want = {
        i: [10 + k for k, w in enumerate(own) if contained(words(t), w)] for i, t in enumerate(texts)
    }
    got = found(contamination(documents(texts), bench))
    # A seed finds every item with few substitutions; the check admits none wrongly.
    assert all(set(got[i]) <= set(want[i]) for i in want)
    missed = sum(len(want[i]) - len(got[i]) for i in want)
    assert missed <= 0.05 * sum(map(len, want.values()))
    assert got[122] == [14]
    assert found(contamination(documents(texts), bench, block_bytes=100)) == got
    extra = documents(texts).selectExpr("*", "1 as best", "2 as found")
    for size in (100, 1 << 20):
        clean = decontaminate(extra, bench, block_bytes=size)
        assert {r["doc_id"] for r in clean.collect()} == {i for i in got if not got[i]}


def test_no_item_shorter_than_the_window_is_missed(llm, documents):
    """Every substitution that the check admits, against all alignments of all items."""
    rng = random.Random(5)
    own = [[f"i{n}x{k}" for k in range(n)] for n in range(1, 20)]
    texts = []
    for item in own:
        for _ in range(20):
            part = list(item)
            for k in rng.sample(range(len(item)), min(len(item), rng.randrange(len(item) // 5 + 2))):
                part[k] = "other"
            texts.append(" ".join(["before"] * rng.randrange(4) + part + ["after"] * rng.randrange(4)))
    bench = items(llm, [(k, " ".join(w)) for k, w in enumerate(own)])
    want = {i: [k for k, w in enumerate(own) if contained(words(t), w)] for i, t in enumerate(texts)}
    assert sum(map(len, want.values())) > len(own)
    assert found(contamination(documents(texts), bench)) == want
    narrow = {
        i: [k for k, w in enumerate(own) if contained(words(t), w, 0.7, 6)] for i, t in enumerate(texts)
    }
    got = found(contamination(documents(texts), bench, window=6, min_share=0.7, masks=("1" * 30,)))
    assert got == narrow


def test_empty_tables_and_repeated_rows(llm, documents):
    bench = items(llm, [(1, "a b c d e f g h i j k l m"), (1, "a b c d e f g h i j k l m")])
    docs = documents([(3, "x a b c d e f g h i j k l m"), (3, "x a b c d e f g h i j k l m"), (None, "y")])
    assert sorted((str(r[0]), r["item_ids"]) for r in contamination(docs, bench).collect()) == [
        ("3", [1]),
        ("3", [1]),
        ("None", []),
    ]
    assert found(contamination(docs, bench.limit(0))) == {3: [], None: []}
    assert contamination(documents([]), bench).collect() == []


def test_query_on_the_table(llm):
    sf_dir = "/root/testdata/sf0.001"
    texts = llm.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    bench = [(r[0], words(r[1])) for r in llm.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = found(op8_spaced_seed_contamination(llm, sf_dir))
    for doc_id, text in texts:
        own = " ".join(words(text))
        whole = [i for i, w in bench if f" {' '.join(w)} " in f" {own} "]
        assert set(whole) <= set(got[doc_id])

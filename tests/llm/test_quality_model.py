"""The classifier on held-out labels, the fertility rules against plain counts."""

import numpy as np

from tallyloom.llm import fertility
from tallyloom.llm.fertility import BANDS, PieceCounts, entropy_share, fertility_rules, script
from tallyloom.llm.fm_classifier import STATISTICS, WORD_BUCKETS, Model, Rows, fit, fold, keep_good, score
from tallyloom.llm.queries import op3_fertility_rules, op5_factorisation_quality

SF_DIR = "/root/testdata/sf0.1"


def test_pairwise_part_is_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    size = WORD_BUCKETS + len(STATISTICS)
    model = Model(0.3, rng.normal(size=size), rng.normal(size=(size, 3)), np.zeros(1), np.ones(1))
    index, value = np.array([5, 9, 700, 3, 8]), rng.normal(size=5)
    margins, _ = model.margins(Rows(np.array([0, 3, 5]), index, value))
    for r, own in enumerate((slice(0, 3), slice(3, 5))):
        i, x = index[own], value[own]
        pairs = sum(
            model.factors[i[a]] @ model.factors[i[b]] * x[a] * x[b] for a in range(len(i)) for b in range(a)
        )
        assert np.isclose(margins[r], 0.3 + model.weights[i] @ x + pairs)


def test_held_out_labels(llm):
    got = op5_factorisation_quality(llm, SF_DIR)
    labels = llm.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").select("quality", "predicted", "score").collect()
    assert len(rows) > 500
    assert sum(r["quality"] == r["predicted"] for r in rows) / len(rows) > 0.97
    good = [r for r in rows if r["quality"] == 1]
    assert sum(r["predicted"] for r in good) / len(good) > 0.99
    assert all(0 <= r["score"] <= 1 for r in rows)
    held = got.where("held_out").select("doc_id").join(labels, "doc_id")
    assert held.where(fold(held["doc_id"]) != 0).isEmpty()


def test_classifier_edges(llm, documents):
    labels = llm.createDataFrame([(0, 1, 0), (0, 1, 0), (1, None, 0), (None, 0, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    docs = documents([(0, "good words " * 9), (1, None), (2, "### $$$ " * 9), (2, "### $$$ " * 9), (None, "x" * 90_000)])
    docs = docs.selectExpr("doc_id", "text", "lang", "source", "cast(null as bigint) as n_chars", "1 as score")
    model = fit(docs, labels)
    rows = score(docs, model).collect()
    assert len(rows) == 5 and all(0 <= r["score"] <= 1 for r in rows)
    assert score(docs.limit(0), model).collect() == []
    assert fit(docs, labels.limit(0)).weights.any() == np.False_
    assert keep_good(docs, model, threshold=0.0).count() == 5
    assert keep_good(docs, model, threshold=1.1).count() == 0


def brute(text):
    text = text or ""
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text)]
    seen, cover = {}, set()
    for k in range(len(words) - 7):
        seen.setdefault(tuple(words[k : k + 8]), []).append(k)
    for places in seen.values():
        if len(places) > 1:
            cover |= {p + j for p in places for j in range(8)}
    lines = [x for x in text.split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    n = len(words)
    counts = (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(cover))
    return (*counts, n < 20 or 100 * len(cover) > 30 * n)


def counted(r):
    return tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))


def test_base_counts(documents):
    phrase = "one two three four five six seven eight nine "
    texts = [None, "", "a\x1cb \x0b c", phrase * 3, "é# |\n\n é# |\né# |\r\n", phrase + "x " * 30 + phrase, "x" * 50_000]
    got = {r["doc_id"]: r for r in fertility_rules(documents(texts)).collect()}
    assert [counted(got[i]) for i in range(len(texts))] == [brute(t) for t in texts]
    assert fertility_rules(documents([])).collect() == []
    assert fertility_rules(documents([(1, "a"), (1, "a")]), lang_col=None).count() == 2


def test_byte_fallback_is_that_of_the_whole_text(llm, monkeypatch):
    counts = PieceCounts()
    rng = np.random.default_rng(3)
    signs = [*"ab é\n  \t\r", "\u3000", "\U0001f600", "\U00012000", "word", "<0x0A>", "▁"]
    texts = ["".join(rng.choice(signs, size=rng.integers(0, 40))) for _ in range(3_000)]
    texts += ["", " ", "\n", "x" * 500, " a  b ", "a\n\nb"]
    rows = llm.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    texts += [r["text"] for r in rows]
    shares = 0
    for text in texts:
        ids = counts.model.encode(text)
        raw = [i for i in ids if counts.model.is_byte(i)]
        assert counts.of(text) == (len(ids), len(raw))
        shares += bool(raw)
    assert shares > 1_500
    assert counts.splits
    whole = [len(counts.model.encode(text)) for text in texts]
    assert counts.tokens(texts).tolist() == whole
    monkeypatch.setattr(fertility, "LOT_CHARS", 3_000)
    monkeypatch.setattr(fertility, "LOT_PARTS", 7)
    assert counts.tokens(texts).tolist() == whole
    assert counts.tokens([]).tolist() == []
    monkeypatch.undo()
    measured = fertility_rules(llm.createDataFrame(rows)).where("fallback_share > 0").count()
    assert measured == sum("\n" in r["text"] or counts.of(r["text"])[1] > 0 for r in rows) > 900


def test_measures():
    assert entropy_share(np.array([1])) == 1.0 and entropy_share(np.array([1] * 9)) == 0.0
    assert [script(t) for t in ("abc", "привет", "漢字", "12 !")] == ["latin", "cyrillic", "cjk", ""]
    assert all(low < high for low, high, *_ in BANDS.values())
    assert PieceCounts().of("a \U00010380\U00010381") == (10, 8)  # a, a blank, four bytes each


def test_rules_on_the_table(llm):
    sf_dir = "/root/testdata/sf0.01"
    texts = {r[0]: r[1] for r in llm.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    got = op3_fertility_rules(llm, sf_dir)
    rows = got.collect()
    assert {r["doc_id"]: counted(r) for r in rows} == {i: brute(t) for i, t in texts.items()}
    assert not any(r["base_failed"] and r["kept"] for r in rows)
    good = got.join(llm.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").where("quality = 1 and not base_failed")
    assert good.where("not kept").isEmpty()

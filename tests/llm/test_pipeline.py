"""The pipeline stage by stage, and as a whole."""

import corpus_pipeline
from tests_llm_helpers import check_pieces, contained, near_groups, repeated_lines, words

SF_DIR = "/root/testdata/sf0.01"


def test_stages(llm, tmp_path):
    docs = llm.read.parquet(f"{SF_DIR}/documents.parquet")
    given, tables = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(llm, given, SF_DIR)
        path = str(tmp_path / name)
        out.write.parquet(path)
        given = llm.read.parquet(path)
        if name != "packing":
            assert given.columns == docs.columns
            assert given.dtypes == docs.dtypes
        tables[name] = given
    texts = {n: {r[0]: r[1] for r in t.select("doc_id", "text").collect()} for n, t in tables.items() if n != "packing"}
    before = {r[0]: r[1] for r in docs.select("doc_id", "text").collect()}

    labels = llm.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    good = {r["doc_id"] for r in labels if r["quality"] == 1}
    bad = {r["doc_id"] for r in labels if r["quality"] == 0}
    assert len(good - texts["quality"].keys()) <= 0.01 * len(good)
    assert len(bad & texts["quality"].keys()) <= 0.1 * len(bad)
    assert all(before[i] == t for i, t in texts["quality"].items())

    want = repeated_lines(list(texts["quality"].items()))
    assert texts["lines"] == {i: w[3] for i, w in want.items() if not w[1] or w[3].strip(" ")}

    groups = near_groups(texts["lines"])
    assert texts["near_duplicates"] == {i: t for i, t in texts["lines"].items() if groups[i][1] == i}

    items = [words(r["text"]) for r in llm.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    for i, text in texts["near_duplicates"].items():
        own = f" {' '.join(words(text))} "
        if any(f" {' '.join(w)} " in own for w in items):
            assert i not in texts["benchmark"]
    gone = texts["near_duplicates"].keys() - texts["benchmark"].keys()
    assert all(any(contained(words(texts["near_duplicates"][i]), w) for w in items) for i in gone)

    check_pieces(tables["packing"].collect(), texts["benchmark"], 1024)


def test_run_gives_the_last_stage(llm):
    rows = corpus_pipeline.run(llm, "/root/testdata/sf0.001").collect()
    assert len(rows) > 100
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)

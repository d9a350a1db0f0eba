import pytest

from tallyloom.llm.store import reach_workers

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def llm(spark):
    reach_workers(spark)
    return spark


@pytest.fixture
def documents(llm):
    """Documents of (doc_id, text) pairs or of texts, numbered from 0."""

    def make(rows, partitions=3):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
        return llm.createDataFrame(full, DOCS).repartition(partitions)

    return make

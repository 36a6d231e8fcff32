import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(spark):
    """A documents table from texts: doc_ids 0, 1, …; three sources."""
    def make(texts, ids=None, sources=None, extra=()):
        ids = list(range(len(texts))) if ids is None else ids
        sources = [f"s{i % 3}" for i in range(len(texts))] if sources is None else sources
        rows = [(i, t, "en", s, None if t is None else len(t)) + tuple(0 for _ in extra) for i, t, s in zip(ids, texts, sources)]
        return spark.createDataFrame(rows, DOCUMENT + "".join(f", `{c}` int" for c in extra))
    return make

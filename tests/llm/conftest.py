import pytest

from plotwise.llm.tables import ship


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Makes a documents table from texts, or from (id, text) or (id, text, source) rows."""
    def make(*rows, source="s"):
        full = []
        for i, r in enumerate(rows):
            if r is None or isinstance(r, str):
                r = (i, r)
            full.append((r[0], r[1], "en", r[2] if len(r) > 2 else source, len(r[1] or "")))
        return spark.createDataFrame(full, DOCUMENTS)
    return make

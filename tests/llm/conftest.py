import pytest

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """documents([(doc_id, text), ...], source=...): a documents table."""

    def make(rows, source="s"):
        full = [(i, t, "en", source, None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCUMENT)

    return make

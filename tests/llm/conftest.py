import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """A table of documents from (doc_id, text) pairs."""

    def make(*rows, **columns):
        values = [(i, t, None, "s", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(values, DOCUMENTS).coalesce(2)

    return make

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Makes a documents table from (doc_id, text) pairs, with columns the operators don't know."""

    def make(*rows, source="s"):
        full = [(i, t, "en", source, None if t is None else len(t), "x", 1, 2) for i, t in rows]
        extra = ", key string, size int, marks int"
        return spark.createDataFrame(full, SCHEMA + extra)

    return make

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table from (doc_id, text) or (doc_id, text, lang) rows."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOC_SCHEMA)
    return make

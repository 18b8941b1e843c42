import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, length long, k1 string, _k1 string, n_lines string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """(doc_id, text) pairs -> a documents table with extra columns, some of
    them named like the operators' own."""
    def make(rows):
        return spark.createDataFrame([(d, t, "en", None, None if t is None else len(t), 7, "x", None, "y") for d, t in rows], DOC_SCHEMA)
    return make

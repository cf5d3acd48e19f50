import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rid string, fp string, kind int, n string, bucket string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text[, source]), with further columns whose names clash with inner ones."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or ""), "x", "y", 1, "z", "w") for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def texts(corpus):
    return {r.doc_id: r.text or "" for r in corpus.collect()}

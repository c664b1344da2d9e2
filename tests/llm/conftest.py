import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, words string"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, source)``, with columns whose names clash with inner ones."""

    def docs(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "x", "y") for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return docs

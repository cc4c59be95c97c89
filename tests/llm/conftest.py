import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """Build a documents table from (doc_id, text[, source]) rows, with a clashing extra column."""
    def make(rows):
        rows = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1]) if r[1] is not None else None, "x") for r in rows]
        return spark.createDataFrame(
            rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, size string")
    return make

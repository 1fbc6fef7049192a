import pytest


@pytest.fixture
def documents(spark):
    """Builds a documents frame from (doc_id, text) pairs, with an extra column of a clashing name."""
    def make(pairs):
        return spark.createDataFrame([(i, t, "en", "src0", len(t) if t is not None else None, "x") for i, t in pairs],
                                     "doc_id long, text string, lang string, source string, n_chars long, key string")
    return make

import pytest
from pyspark.sql import types as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) rows."""
    def make(rows, extra=""):
        full = []
        for r in rows:
            r = tuple(r) + (None,) * (4 - len(r)) if len(r) < 4 else tuple(r)
            full.append(r + (len(r[1]) if r[1] is not None else None,))
        return spark.createDataFrame(full, DOCS)
    return make

import pytest

from stocktake.llm.shared import prepare


@pytest.fixture(scope="session")
def llm(spark):
    return prepare(spark)


def docs(spark, rows):
    """Documents from (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars int")

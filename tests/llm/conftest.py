import pytest

pytest.importorskip("tidewell.llm")


@pytest.fixture
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names clash."""
    long = "word " * 40_000
    rows = [(1, None, "en", "a", 0, "x"), (2, "", "en", None, 0, "x"), (3, "one two", None, "a", 7, None), (3, "one two", None, "a", 7, None), (None, "no id here", "en", "a", 1, "x"), (5, long, "en", "b", 9, "x"), (6, "\n\n  \t", "de", "a", 1, "x")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, n_tokens string").withColumnRenamed("lang", "TEXT")


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")

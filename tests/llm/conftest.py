import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs(spark):
    """Makes a documents table of (doc_id, text[, lang]) rows."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)
    return make


@pytest.fixture(scope="session")
def awkward():
    """Nulls, empty and long texts, ties, repeated rows, odd characters."""
    return [(1, None), (2, ""), (3, " \t\n"), (4, "one two three four five"), (4, "one two three four five"),
            (5, "one two three four five"), (None, "null id text here"), (6, "é" * 300 + " ﬁ 日本語 😀"), (7, "x" * 5000),
            (8, "word " * 3000), (9, "A.")]

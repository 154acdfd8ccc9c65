import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # extra columns whose names operators might use themselves
    T.StructField("score", T.StringType()), T.StructField("fp", T.StringType()),
    T.StructField("secrets", T.StringType()), T.StructField("component", T.StringType()),
    T.StructField("id", T.StringType()), T.StructField("n", T.StringType()),
])


@pytest.fixture()
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source)."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "x", "x", "x", "x", "x", "x") for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make

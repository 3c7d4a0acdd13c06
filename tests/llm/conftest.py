import pytest
from pyspark.sql import types as T

from sievework.llm.common import shipped

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # columns that clash with names of the operators' own
    T.StructField("row", T.StringType()), T.StructField("score", T.StringType()), T.StructField("k1", T.LongType()),
])


@pytest.fixture(scope="session")
def documents(spark):
    """Makes documents of (id, text) or (id, text, lang)."""
    shipped(spark)

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or ""), "x", None, 1) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make

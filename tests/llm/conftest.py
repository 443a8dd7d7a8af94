import pytest
from brute import texts
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use for columns of their own
    *(T.StructField(name, T.StringType()) for name in ("fp", "words", "key", "row", "host", "path", "spans", "ids", "hash", "text_key", "node", "label")),
])


@pytest.fixture(scope="session")
def docs(spark):
    rows = [(i, t, "en" if (i or 0) % 3 else None, f"s{(i or 0) % 4}", -1, *(["clash"] * 12)) for i, t in texts()]
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)

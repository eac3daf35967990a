import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators might use inside
        T.StructField("id", T.StringType()),
        T.StructField("copies", T.StringType()),
        T.StructField("_id", T.StringType()),
    ]
)


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text[, lang[, source]])."""

    def make(*rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "a", None, "x", "y", "z") for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")

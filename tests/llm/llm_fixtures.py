from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])


@pytest.fixture
def frame(spark):
    """Documents from (doc_id, text) pairs, with extra columns named like internal ones."""
    def make(pairs, extra=("_w", "h", "_row", "length")):
        schema = T.StructType([*DOCS.fields, *(T.StructField(c, T.StringType()) for c in extra)])
        rows = [(i, t, None, "s", None, *[None] * len(extra)) for i, t in pairs]
        return spark.createDataFrame(rows, schema)
    return make


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")

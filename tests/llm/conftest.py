from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def documents(spark):
    """A frame of documents from texts, or from (id, text) pairs."""

    def make(texts, extra=None):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        schema = T.StructType(DOCUMENTS.fields + ([T.StructField(extra, T.StringType())] if extra else []))
        more = ("kept aside",) if extra else ()
        return spark.createDataFrame([(i, t, "en", "a", None if t is None else len(t), *more) for i, t in rows], schema)

    return make

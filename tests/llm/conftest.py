from __future__ import annotations

import pytest
from pyspark.sql import types as T

FIELDS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that operators use inside.
    T.StructField("own_key", T.StringType()), T.StructField("copies", T.LongType()), T.StructField("size", T.StringType()),
    T.StructField("own_text", T.StringType()), T.StructField("nth", T.IntegerType()),
])


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), with extra columns of clashing names."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), "k", -1, "x", "t", 9) for r in rows]
        return spark.createDataFrame(full, FIELDS).repartition(3)
    return make

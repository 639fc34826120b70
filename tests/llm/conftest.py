from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (id, text) pairs; further columns with names the operators use inside."""

    def make(rows, clashing=True):
        full = [(i, t, "en" if i is None or i % 2 else None, "s", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(full, DOCUMENT)
        if clashing:
            for name in ("id", "key", "n", "spans", "component", "score", "weight", "tokens", "row"):
                df = df.selectExpr("*", f"'x' as `{name}`")
        return df

    return make

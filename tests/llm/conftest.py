from __future__ import annotations

import pytest
from llm_rows import ODD, SF
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents frame of texts (or (id, text) pairs); ids count from 0."""
    def make(rows, extra=()):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        schema = T.StructType(DOCS.fields + [T.StructField(c, T.StringType()) for c in extra])
        data = [(i, t, "en", "s", None if t is None else len(t), *["x"] * len(extra)) for i, t in rows]
        return spark.createDataFrame(data, schema)
    return make


@pytest.fixture(scope="session")
def odd(docs_of):
    """The odd rows, with extra columns named like the operators' own."""
    return docs_of(ODD, extra=("score", "spans", "ids", "n", "key", "text_hash", "set_key", "word"))


@pytest.fixture(scope="session")
def none(docs_of):
    return docs_of([])


@pytest.fixture(scope="session")
def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def real_rows(real):
    return [(r.doc_id, r.text) for r in real.orderBy("doc_id").collect()]

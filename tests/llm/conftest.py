import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def docs(spark):
    """A table of documents from (doc_id, text) pairs."""

    def make(rows, **more):
        full = [(i, t, more.get("lang", "en"), more.get("source", "s"), None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture
def table(tmp_path):
    """A folder with the given tables, as the queries read them."""

    def make(**tables):
        for name, df in tables.items():
            df.write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return make

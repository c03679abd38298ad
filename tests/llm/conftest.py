import numpy as np
import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table from (doc_id, text, lang, source) tuples, with columns whose names clash with those used inside."""

    def make(rows):
        schema = T.StructType(
            [
                T.StructField("doc_id", T.LongType()),
                T.StructField("text", T.StringType()),
                T.StructField("lang", T.StringType()),
                T.StructField("source", T.StringType()),
                T.StructField("n_chars", T.LongType()),
                T.StructField("size", T.StringType()),
                T.StructField("block", T.StringType()),
                T.StructField("node", T.StringType()),
                T.StructField("hash", T.StringType()),
            ]
        )
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, None, None)[:4] if len(row) < 4 else row
            full.append((doc_id, text, lang, source, None if text is None else len(text), "x", "y", "z", "w"))
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def words():
    """Pseudo-random texts of invented words."""

    def make(count, seed=0, vocabulary=400):
        random = np.random.default_rng(seed)
        names = [f"w{i}{'abcdefghij'[i % 10]}" for i in range(vocabulary)]
        return " ".join(names[i] for i in random.integers(0, vocabulary, count))

    return make

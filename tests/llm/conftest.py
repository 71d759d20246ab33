import random

import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table of (doc_id, text) pairs, with columns whose names steps use too."""

    def make(rows, lang="en"):
        schema = T.StructType(
            [
                T.StructField("doc_id", T.LongType()),
                T.StructField("text", T.StringType()),
                T.StructField("lang", T.StringType()),
                T.StructField("source", T.StringType()),
                T.StructField("n_chars", T.LongType()),
                T.StructField("chunk", T.StringType()),
                T.StructField("kept", T.StringType()),
                T.StructField("c0", T.LongType()),
            ]
        )
        data = [(i, t, lang, "s", len(t or ""), "x", "y", 7) for i, t in rows]
        return spark.createDataFrame(data, schema)

    return make


@pytest.fixture
def prose():
    """Invented prose from a seeded generator."""

    def make(seed, n_words, vocabulary=400):
        rng = random.Random(seed)
        words = [
            "".join(rng.choice("abdeilmnorst") for _ in range(rng.randrange(2, 9)))
            for _ in range(vocabulary)
        ]
        rng = random.Random(seed * 7919 + 1)
        return " ".join(rng.choice(words) for _ in range(n_words))

    return make

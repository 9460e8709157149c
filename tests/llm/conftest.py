import random

import pytest
from pyspark.sql import types as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs_of(spark):
    """Rows of a documents table from (doc_id, text) pairs, over several partitions."""
    def make(pairs, **columns):
        rows = [(i, t, "en", "src", None if t is None else len(t)) for i, t in pairs]
        return spark.createDataFrame(rows, DOCS).repartition(3)
    return make


@pytest.fixture()
def prose():
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]

    def make(n, seed=None):
        r = random.Random(seed) if seed is not None else rng
        return " ".join(r.choice(vocabulary) for _ in range(n))
    return make


@pytest.fixture()
def clashing():
    """Adds columns whose names operators use inside."""
    from pyspark.sql import functions as F

    def add(df):
        return df.withColumns({c: F.lit(c) for c in
                               ("fp", "text_key", "pos", "words", "key", "start", "n", "u", "hash", "component_id", "label", "score")})
    return add

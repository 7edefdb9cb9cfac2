import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    """Rows (doc_id, text, lang, source) -> documents, with columns whose names operators use themselves."""
    def make(rows, extra=("id", "hash", "key", "size", "bucket")):
        df = spark.createDataFrame([(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows], DOCS)
        from pyspark.sql import functions as F
        return df.select("*", *[F.lit("x").alias(c) for c in extra])
    return make


@pytest.fixture(scope="session")
def prose():
    """n invented words from a seed; different seeds share almost no five words."""
    import random

    def make(seed, n):
        rng = random.Random(seed)
        return " ".join("".join(rng.choice(["ka", "lo", "mi", "ter", "un", "st", "re"]) for _ in range(rng.randint(1, 4))) for _ in range(n))
    return make

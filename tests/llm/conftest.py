import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def make(spark):
    def build(rows):
        return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows], DOCS)
    return build


@pytest.fixture(scope="session")
def odd(make):
    """Nulls in every column, empty and very long texts, repeated rows and ids, ties."""
    long = " ".join(f"w{i % 977}x{i // 977}" for i in range(20_000))
    return make([(1, "a b c", "en", "s1"), (1, "a b c", "en", "s1"), (2, None, None, None), (None, "x " * 60, "en", "s1"),
                 (3, "", "xx", "s2"), (4, long, "en", None), (5, long + " tail", "en", "s2"), (None, None, None, None),
                 (6, " \t\n", "de", "s3")])


@pytest.fixture(scope="session")
def empty(make):
    return make([])

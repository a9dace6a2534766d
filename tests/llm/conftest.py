import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
EXTRA = T.StructType(DOCS.fields + [T.StructField(c, T.StringType()) for c in ("row", "rk", "spans", "base", "q", "score", "unit", "id", "start", "t")])

LONG = " ".join(f"word{i % 977}" for i in range(60_000))
ODD = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (4, "one"), (None, "a text without an id of its own"), (None, None),
    (5, LONG), (6, LONG), (7, "çà et là ÉÉ \U0001F600 ß <|endoftext|> tail  with  double spaces\r\nnew line"), (8, "x" * 30_000),
    (9, "!!! ??? ..."), (10, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 3),
]


@pytest.fixture()
def odd_docs(spark):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in ODD], DOCS)


@pytest.fixture()
def wide_docs(spark):
    """Extra columns whose names clash with those the operators use."""
    return spark.createDataFrame([(i, t, "en", "s", 0, *(["x"] * 10)) for i, t in ODD], EXTRA)


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture()
def make_docs(spark):
    return lambda rows: spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


@pytest.fixture()
def benchmark(spark):
    return spark.createDataFrame([(1, "one two three"), (2, "a b c d e f g h i j k l m n o"), (3, None), (4, ""), (None, "word1 word2 word3 word4")],
                                 "item_id long, text string")


@pytest.fixture()
def labels(spark):
    return spark.createDataFrame([(4, 1, 1), (5, 0, 0), (6, 1, 0), (7, 1, None), (None, 1, 1), (9, None, 0), (9, 1, 1)],
                                 "doc_id long, quality int, toxic int")

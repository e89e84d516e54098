import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("id", T.StringType()),
                     T.StructField("key", T.IntegerType()), T.StructField("_text", T.StringType()), T.StructField("_doc", T.LongType()),
                     T.StructField("_size", T.LongType()), T.StructField("token_ids", T.StringType())])


def rows_of(pairs, source="s"):
    """Document rows with extra columns whose names operators may use inside."""
    return [(i, t, "en", source, None if t is None else len(t), "x", 1, "other", 2, 3, "ids") for i, t in pairs]


@pytest.fixture(scope="session")
def make_docs(spark):
    return lambda pairs, **kw: spark.createDataFrame(rows_of(pairs, **kw), DOCS)


def long_text(words=30_000):
    return " ".join(f"w{(i * 7919) % 10007}x{i}" for i in range(words)) + "."


#: null and empty texts, white space, ties, repeated rows, wide characters, a very long text
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One"), (6, "two words"), (7, "a b c d e f g h i j k l m n o p q r s t u v w."),
       (8, "A B C d e f g h i j k l m n o p q r s t u v w."), (9, long_text()), (10, long_text() + " tail"), (11, "é日本 \U0001F600 text with wide"),
       (12, "x" * 120), (13, "x" * 120), (14, "nul \x00 byte " * 9), (15, "line\n" * 12), (16, "the  double  spaces \n\n and \r\n ends  ")]

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)


@pytest.fixture
def docs(spark):
    """docs(rows) -> frame; a row is (doc_id, text[, lang[, source]])."""
    def make(rows):
        return spark.createDataFrame([(*r, *[None] * (4 - len(r))) for r in rows], DOCS)

    return make


@pytest.fixture
def awkward(docs):
    """Nulls, empty and long texts, ties, repeated rows."""
    long = "the whale and the ship, again. " * 4000
    return docs(
        [
            (1, None, "en", "a"),
            (None, "a text without an id", None, None),
            (None, None, None, None),
            (2, "", "en", "a"),
            (3, "  \n\t ", None, "b"),
            (4, long, "en", "a"),
            (5, long, "en", "a"),
            (6, "same row", "de", "b"),
            (6, "same row", "de", "b"),
            (6, "other text, same id", "de", "c"),
            (7, "日本語 ünïcode \U0001f600 <|endoftext|> it's", "ja", "c"),
        ]
    )

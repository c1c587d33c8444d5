import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use themselves
        T.StructField("row", T.StringType()),
        T.StructField("kept", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def table(spark):
    """Documents from (doc_id, text[, lang[, source]]) rows, with clashing extra columns."""

    def make(rows):
        full = [(i, t, *(more or ()), *([None] * (2 - len(more))), None if t is None else len(t), "r", "k") for i, t, *more in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd(table):
    """Nulls, empty and blank texts, one long text, repeated ids and rows."""
    long = " ".join(f"w{i % 9973}x{i}" for i in range(40_000))
    return table(
        [
            (1, None, None, None),
            (2, "", "en", "a"),
            (3, " \n\t ", "en", "a"),
            (4, long, None, "b"),
            (None, "a text without an id\nand two lines", "xx", "c"),
            (5, "the same text here", "en", "a"),
            (5, "the same text here", "en", "a"),
            (5, "another text of this id", "en", None),
            (6, "emoji \U0001f600 \u2581 caf\u00e9 \u4e2d\u6587 \x1c x", "fr", "d"),
        ]
    )

import os

import pytest
from pyspark.sql import types as T

os.environ.setdefault("PYTHONPATH", os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("name", T.StringType()),  # clashes with inner columns
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_lines", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows and copies."""
    base = "one two three four five six seven eight nine ten eleven twelve " * 3
    rows = [
        (1, base + "\nsecond line of this text", "en", "a", 1, "x", 1, 1),
        (2, base + "\nsecond line of this texz", "en", "a", 1, None, None, None),
        (2, base + "\nsecond line of this texz", "en", "a", 1, None, None, None),
        (3, None, None, None, None, None, None, None),
        (None, base, "en", None, None, None, None, None),
        (4, "", "de", "b", 0, "", 0, 0),
        (5, " \n\t ", "de", "b", 0, "", 0, 0),
        (6, "der und die " * 30_000, "de", "b", 1, "", 0, 0),
        (7, "wörd ▁ <s> <|endoftext|>  zwei　drei", None, "b", 1, "", 0, 0),
        (8, "a b c", "en", "c", 1, "", 0, 0),
        (9, "A b C", "en", "c", 1, "", 0, 0),
    ]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)

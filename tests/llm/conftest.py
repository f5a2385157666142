import pytest
from pyspark.sql import functions as F

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, row string, component string"
LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu " * 4000


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and extra
    columns whose names clash with columns that operators make."""
    p = "the quick brown fox jumps over the lazy dog while seven wizards watch the quiet harbour at dawn today"
    rows = [
        (1, p, "en", "a"), (2, p, "en", "a"), (3, p + " again", None, "b"), (4, None, "en", "b"), (5, "", "en", None), (6, "   \t\n", "en", None),
        (7, LONG, "en", "a"), (8, "one two", "en", "a"), (9, "one two", "en", "c"), (10, "x", None, "c"), (10, "x", None, "c"),
        (11, "Some other words that nobody else has written anywhere in this small table, honestly.", "en", "c"), (None, p, "en", "a"), (None, None, None, None),
        (12, "éèê ñ ß — “quoted” text with ümlauts and emoji 😀 in it, repeated. " * 3, "de", "b"),
    ]
    return spark.createDataFrame([(*r, 5, 1.5, "r", "c") for r in rows], DOC_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark, edge_docs):
    return edge_docs.filter(F.lit(False))


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.01/labels.parquet")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")

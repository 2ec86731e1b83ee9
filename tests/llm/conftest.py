import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ("_row", "kept", "size", "score", "key", "n", "h", "bucket", "total", "rank", "_id", "_text", "good")


@pytest.fixture(scope="session")
def edge_rows():
    """NULLs in every column, empty, blank and very long texts, ties, repeated rows."""
    long_text = " ".join(f"w{i % 9973}x{i % 7}" for i in range(30_000))
    return [
        (1, "The cat sat on the mat and the dog sat on the log", "en", "a", 49),
        (1, "The cat sat on the mat and the dog sat on the log", "en", "a", 49),
        (2, None, None, None, None),
        (3, "", "en", "b", 0),
        (4, " \t\n\r ", "en", "b", 5),
        (None, "Une phrase de plus, été", "fr", None, 23),
        (None, None, None, None, None),
        (5, long_text, "en", "a", len(long_text)),
        (6, "É é ▁ ² m².x 日本語 \U0001f600", None, "b", 10),
        (7, "THE CAT SAT ON THE MAT AND THE DOG SAT ON THE LOG", "en", "c", 49),
        (8, "one", "en", "c", 3),
        (9, "one", "en", None, 3),
    ]


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    """The edge rows with extra columns whose names clash with the operators' own."""
    df = spark.createDataFrame(edge_rows, SCHEMA).repartition(3)
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASH})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")

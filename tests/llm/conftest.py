import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i * 7919 % 1009}" for i in range(9_000))


def odd_rows():
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows."""
    a = "the quick brown fox jumps over the lazy dog and runs into the green forest by the river today " * 6
    rows = [
        (1, a, "en", "web", len(a)),
        (2, a, "en", "web", len(a)),
        (2, a, "en", "web", len(a)),
        (3, a + "with another end", None, "web", None),
        (4, None, "en", "web", None),
        (5, "", "en", None, 0),
        (6, " \t\n\r ", None, None, 4),
        (7, "één twee　drie 日本語 \U0001f600", "nl", "books", 20),
        (8, LONG, "en", "books", len(LONG)),
        (9, "x" * 2_000, "en", "junk", 2_000),
        (None, "a row without an id but with words in it", None, None, None),
        (10, "###", "en", "junk", 3),
        (11, "one two", "en", "web", 7),
        (12, "One  two", "en", "web", 8),
    ]
    return rows


@pytest.fixture()
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture()
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    """(documents frame, list of (doc_id, text, lang, source)) of the smallest test data."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return df, [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in df.collect()]

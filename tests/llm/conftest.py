import pytest

SCHEMA = "doc_id long, text string, source string, sig string, row string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and blank texts, repeated rows, a very long text, columns with clashing names."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [
        (1, "the same text of more than five words here", "a", "x", "y"),
        (2, "the same  text of more\tthan five words here ", "a", None, None),
        (2, "the same  text of more\tthan five words here ", "a", None, None),
        (3, None, None, None, None),
        (4, "", "b", "s", "r"),
        (5, " \n\t ", "b", "s", "r"),
        (None, "a text without an id that is long enough", "b", "s", "r"),
        (6, long, "c", "s", "r"),
        (7, "Ünïcödé 日本語 😀 \x00 end", "c", "s", "r"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, id long, size int, "
    "pick string, digest string, component string, row long, target double, words string")


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls in every column, blank and long texts, repeated rows, columns with taken names."""
    long_text = " ".join(f"word{k % 7919} and" for k in range(30_000))
    plain = "The quick brown fox jumps over the lazy dog near the river bank today."
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, None), (4, plain, "en", "a"),
        (4, plain, "en", "a"), (5, plain, "en", None), (6, long_text, "en", "b"),
        (None, "no id here but words", "de", "b"), (7, "x", None, "c"), (8, "12 34 !!", "de", "c"),
        (9, None, None, None),
    ]
    extra = (None, 1, None, "d", "c", None, 2.0, "w")
    return spark.createDataFrame([(*r, None, *extra) for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)

import pytest

#: Rows that every operator on documents must take: nulls, empty and blank texts, ties, repeated rows, long texts.
PROSE = ("the house of the river and the people in it was a place for that old man to be on the water as they "
         "were with him at this time from the town ")


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [
        (1, PROSE * 3, "en", "s"), (2, PROSE * 3, "en", "s"),  # exact copies
        (3, PROSE * 3 + "and one more word", "en", "s"),
        (4, "", "en", "s"), (5, None, "en", "s"), (6, " \t\n ", None, "s"), (7, "word", "en", None),
        (8, "word", "fr", "s"), (None, "a text without an id " * 30, "en", "s"), (None, None, None, None),
        (9, "same row " * 60, "en", "s"), (9, "same row " * 60, "en", "s"),  # fully repeated
        (9, "same id, other text", "en", "s"),
        (10, "élan vital où naïve ça " * 40000, "fr", "s"),  # very long
        (11, "!!! ??? 123", "en", "s"), (12, "x" * 5000, "en", "s"),
    ]
    # further columns, some with names that operators use inside
    return spark.createDataFrame([(*r, "k", 7, "c") for r in rows],
                                 "doc_id long, text string, lang string, source string, k1 string, lo int, cut string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)

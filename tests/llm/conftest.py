import pytest

from tradewind.session import ship

WORDS = [f"w{i}" for i in range(400)]
PASSAGE = " ".join(WORDS[:60])


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def corpus(spark):
    """Copies, near copies, ties, NULLs, empty and long texts, repeated rows and ids."""
    long = " ".join(f"x{i * 7919 % 5003}" for i in range(6000))
    rows = [
        (1, PASSAGE + " " + " ".join(WORDS[100:140]), "en"), (2, PASSAGE + " " + " ".join(WORDS[100:140]), "en"),
        (3, PASSAGE + " " + " ".join(WORDS[100:139]) + " other", "en"), (4, " ".join(WORDS[200:260]) + " " + PASSAGE, "fr"),
        (5, None, "en"), (6, "", None), (7, " \n\t ", "de"), (8, "two words", "en"), (8, "two words", "en"), (None, "lone", "fr"),
        (None, None, None), (9, long, "de"), (10, "12 34 !!", "en"), (11, "a b c d", "es"), (12, "a b c d", "es"),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string").cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string")

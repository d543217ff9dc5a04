import pytest
from made_up import words

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def awkward():
    """Rows with all that may go wrong: nulls, empty, blank, repeated, copied, very long, odd bytes."""
    long = words(1, 30_000)
    near = words(2, 400).split()
    rows = [
        (5, None, "en", "a", 0), (6, "", "en", "b", 0), (7, " \n\t \n", None, None, 5), (8, "one", "en", "a", 3), (8, "one", "en", "a", 3), (9, "ONE", "en", "c", 3),
        (10, long, "en", "a", len(long)), (11, "x" + long, "en", "b", len(long) + 1), (12, " ".join(near), "fr", "a", 1), (13, " ".join([*near[:200], "changed", *near[201:]]), "fr", "b", 1),
        (14, "tab\there\x00nul \x7f \U0001f600 naïve", "de", "c", 9), (15, words(3, 60), "de", "d", 9), (16, words(3, 60) + "\n" + words(4, 80), "de", "e", 9), (None, words(5, 30), "en", "a", 1), (17, "ab " * 3000, "en", "f", 9), (18, "<|endoftext|> 7 it's 77 ΑΣ İ", "en", "f", 9),
    ]
    return rows


@pytest.fixture
def docs(spark, awkward):
    return spark.createDataFrame(awkward, DOCS)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], DOCS)

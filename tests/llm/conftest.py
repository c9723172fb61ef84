import os

import pytest


@pytest.fixture(scope="session", autouse=True)
def importable():
    """Workers import the package by its path."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        os.environ["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, key string, body string, mark string, n long, slot long, word string, host string"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text, lang, source) with extra columns whose names operators use inside."""

    def make(rows):
        return spark.createDataFrame([(*r, None, "x", None, "y", 1, 2, "z", "h") for r in rows], COLUMNS)

    return make


@pytest.fixture(scope="session")
def odd(frame):
    """NULLs everywhere, empty and blank texts, repeated rows, ties, a very long text and copies."""
    long = " ".join(f"w{i % 9973}" for i in range(120_000))
    return frame(
        [
            (None, None, None, None), (1, None, "en", "a"), (2, "", "en", None), (3, " \n\t ", None, "a"), (4, "same words in a copied text here", "en", "a"), (5, "same words in a copied text here", "de", "b"),
            (5, "same words in a copied text here", "de", "b"), (None, "same words in a copied text here", "en", "a"), (6, long, "en", "b"), (7, long + " tail", None, None), (8, "one", "en", "é"), (8, "two", "en", "é"),
        ]
    )

"""Fixtures shared by the tests of the training-data operators."""

import random

import pytest

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def long_text():
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdeéio", k=rng.randint(1, 9))) for _ in range(3000)]
    return " ".join(rng.choices(words, k=300_000))


@pytest.fixture(scope="session")
def odd_docs(spark, long_text):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, clashing extra columns."""
    rows = [
        (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a"),
        (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a"),
        (2, "the quick brown fox jumps over the lazy dog again and again", "en", "b"),
        (3, None, "en", "a"), (4, "", None, None), (5, "  \n\t ", "de", "b"), (6, "word", "de", None),
        (7, long_text, "fr", "c"), (8, "x" * 600_000, "fr", "c"), (None, "no id here at all", "en", "a"),
        (None, None, None, None), (9, "12 34 + 56", "en", "a"), (10, "<|endoftext|> a  b\r\n\r\nc'll", "en", "b"),
        (11, "\U0001f600 日本語 éè \x00 z", "fr", "a"),
    ]
    names = ["score", "hits", "items", "n_words", "size", "target", "copies", "rate", "_id", "rep", "lang_pred",
             "labels", "found", "n_tokens", "leaf_chars", "root", "spans"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame([(*r, 0, *["clash"] * len(names)) for r in rows], schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)

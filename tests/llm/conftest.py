from __future__ import annotations

import pytest

TEXT = "the quick brown fox jumps over the lazy dog while seven small birds watch from a tall old tree near water"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, id long, key string, n long"


@pytest.fixture
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing extra columns."""
    long = " ".join(f"w{k % 997}x{k}" for k in range(30_000))
    rows = [
        (1, TEXT, "en", "a", 1, 0.5, 1, "k", 1),
        (2, TEXT, "en", "a", 1, 0.5, 1, "k", 1),
        (2, TEXT, "en", "a", 1, 0.5, 1, "k", 1),
        (3, TEXT.upper(), None, None, None, None, None, None, None),
        (4, None, "en", "b", 0, 0.1, 2, "k", 2),
        (5, "", None, "b", 0, 0.1, 2, "k", 2),
        (6, " \n\t ", "de", None, 4, 0.1, 2, "k", 2),
        (7, "word", "en", "c", 4, 0.1, 2, "k", 2),
        (8, long, "en", "c", len(long), 0.1, 2, "k", 2),
        (None, TEXT, "en", "a", 1, 0.5, 1, "k", 1),
        (10, TEXT + " x", "fr", "a", 1, 0.5, 1, "k", 1),
        (11, "Éa\x0bb\x85c 'tis <|endoftext|> ünï \U0001f600", "fr", "a", 1, 0.5, 1, "k", 1),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], DOCS)

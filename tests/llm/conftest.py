from __future__ import annotations

import pytest


@pytest.fixture
def odd_docs(spark):
    """Null ids and texts, empty, short and very long texts, ties, repeated rows, and columns of clashing names."""
    words = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))
    rows = [
        (1, "alpha beta gamma delta epsilon zeta", "a"),
        (1, "alpha beta gamma delta epsilon zeta", "a"),
        (1, "another text under the same id, quite different", "b"),
        (2, None, None),
        (3, "", "c"),
        (4, "   \n\t ", "c"),
        (5, "One", None),
        (None, "alpha beta gamma delta epsilon zeta", "d"),
        (None, None, None),
        (7, words, "long"),
        (8, words + " tail", "long"),
        (9, "naïve café ÉTÉ — “quotes” don't stop", "e"),
    ]
    schema = "doc_id long, text string, score string, mark string, node string, key string, found string, n_words string"
    return spark.createDataFrame([(i, t, s, "m", "n", "k", "f", "w") for i, t, s in rows], schema)


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.limit(0)

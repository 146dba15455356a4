"""Documents that every operator must bear."""

import pytest

AWKWARD = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today", "en", "b"),
    (2, "THE quick brown fox jumps over the lazy dog near the old river bank today", "en", "b"),
    (2, "THE quick brown fox jumps over the lazy dog near the old river bank today", "en", "b"),
    (None, "the quick brown fox jumps over the lazy dog near the old river bank today", None, None),
    (None, "a text without an id", None, "a"),
    (3, None, "en", "a"),
    (4, "", "en", None),
    (5, " \t\r\n ", "en", "a"),
    (6, "one", "en", "c"),
    (7, "Ünïcode É ÀB İstanbul Σίσυφος 中文 😀 <|endoftext|> it's", "fr", "c"),
    (8, "long " + " ".join(f"w{i % 977}" for i in range(30_000)), "en", "a"),
    (9, "x" * 20_000, "en", "a"),
    (9, "another text of a repeated id", "en", "d"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and very long texts, repeated rows and ids, and columns named like inner ones."""
    rows = [(*r, i, "x", float(i), "k") for i, r in enumerate(AWKWARD)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, row long, name string, size double, k1 string")


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)

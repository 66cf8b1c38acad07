import pytest

LONG = "long " + " ".join(f"word{i % 977}x{i % 13}" for i in range(20_000))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from the big bad wolf today.", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog and runs away from the big bad wolf today.", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog and runs away from the big bad wolf today.", "en", "a"),
    (3, "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf tonight", "en", None),
    (4, "", "en", "b"),
    (5, None, None, "b"),
    (6, "one two", "de", "b"),
    (7, "\t\n ", "de", None),
    (8, LONG, "fr", "a"),
    (9, "é" * 50 + " ñandú über straße 中文 字符 " * 5, None, None),
    (None, "a row without an id is a row too", "en", "c"),
    (10, "Write to jo.doe_1@mail.example.com or call +1 (555) 123-4567 now, host 10.0.0.1, card 4111 1111 1111 1111.", "en", "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string, size long, kept string, score string, n_words string, sig string, place string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeats, and extra columns whose names operators use for themselves."""
    return spark.createDataFrame([(*r, 7, "k", "s", "n", "g", "p") for r in TEXTS], SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)

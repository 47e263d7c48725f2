import pytest

ODD = [
    (1, "The quick brown fox jumps over the lazy dog by the river bank today", "en", "a", 66),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (None, "a row without an id, and some words to count in it", None, "b", 3),
    (5, "THE quick brown fox jumps over the lazy dog by the river bank today", "en", "b", 66),
    (6, "the quick brown fox jumps over the lazy dog by the river bank today", "en", "c", 66),
    (6, "the quick brown fox jumps over the lazy dog by the river bank today", "en", "c", 66),
    (7, " \n\t ", "xx", None, 4),
    (8, "word " * 40_000, "en", "a", 200_000),
    (9, "x" * 150_000, "en", "c", 150_000),
    (10, "é́ ñ 中文 😀 it's  a\tb \n c </s> <|endoftext|>", "en", "a", 30),
]


@pytest.fixture(scope="session")
def shipped(spark):
    from strata.llm.common import ship

    ship(spark)
    return spark


@pytest.fixture(scope="session")
def odd(shipped):
    """Nulls, empty and long texts, ties, repeated rows and columns with clashing names."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, key string, score string, digest string, `range` string, size string"
    return shipped.createDataFrame([(*r, "k", "y", "s", "d", "r", "z") for r in ODD], schema)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def labels(shipped):
    rows = [(i, i % 2, int(i == 6), "x") for i in (1, 2, 3, 5, 6, 7, 8, 9, 10)] + [(None, 1, 0, "x"), (4, None, None, None)]
    return shipped.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")

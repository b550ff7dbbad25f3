"""Rows that every operator has to stand: nulls, empty and long texts, ties, repeated rows, odd columns."""

import pytest

ODD_TEXTS = [
    None,
    "",
    " \n\t ",
    "a",
    "The quick brown fox doesn't jump over 12 lazy dogs; they'll say it's fine.\n\n  Twice.\n",
    "naïve Ünïcode 漢字 ٣٤ \x1c\x85 🙂🙂 <|endoftext|> x",
    "word " * 3000,
    "x" * 5000,
    "one two three four five six seven\none two three four five six seven\n" * 3,
]


@pytest.fixture(scope="session")
def odd_rows():
    rows = [(k, text, "en" if k % 2 else None, "s", None) for k, text in enumerate(ODD_TEXTS)]
    return [*rows, rows[4], (None, "an id that is null", "en", None, 1), (4, "another text of id four", "en", "s", 2)]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """Documents whose further columns have names that operators use themselves."""
    frame = spark.createDataFrame(odd_rows, "doc_id long, text string, lang string, source string, score int")
    for name in ("n_tokens", "fingerprint", "component_id", "kept", "place", "line", "h", "key", "fp", "held_out", "block", "predicted", "norm", "flag"):
        frame = frame.selectExpr("*", f"'{name}' as {name}")
    return frame


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (None, 1, 1), (6, 0, 1), (6, 1, 0), (99, 0, 0), (7, None, None)], "doc_id long, quality int, toxic int")

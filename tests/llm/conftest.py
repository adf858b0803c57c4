from __future__ import annotations

import pytest
from pyspark.sql import functions as F

DOC = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i} the of" for i in range(30_000))
# no word but the function words occurs twice, no digits
WORDS = iter(f"{a}{b}{c}" for a in "bdfgkl" for b in "aeiou" for c in "mnprstvz")
PROSE = "\n".join(f"The {' '.join(next(WORDS) for _ in range(9))} of {next(WORDS)} and {next(WORDS)}." for _ in range(12))

# NULLs in every column, empty and very long texts, ties, repeated rows
EDGE_ROWS = [
    (1, PROSE, "en", "a", len(PROSE)),
    (2, PROSE, "en", "a", len(PROSE)),
    (2, PROSE, "en", "a", len(PROSE)),
    (3, None, None, None, None),
    (4, "", "", "", 0),
    (5, " \t\n \x0b", "en", "b", 5),
    (6, LONG, "en", "b", None),
    (None, PROSE, "en", "a", 1),
    (None, None, None, None, None),
    (None, None, None, None, None),
    (7, "ÉTÉ été Straße\r\nok x", "fr", "b", 9),
    (8, "One two three", "en", "b", 13),
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE_ROWS, DOC)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="module")
def clashing(edge):
    """Extra columns with names that the operators use themselves."""
    names = "row _text _words fp _key n_words kept leaf form w term label score html key _lead _row_key ids words page_id Text2"
    return edge.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names.split())])

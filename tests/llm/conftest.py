from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def sentence(seed: int, n: int) -> str:
    """Words in an order that hardly repeats."""
    x, out = seed * 7919 + 13, []
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 8) % len(WORDS)] + str((x >> 16) % 97))
    return " ".join(out)


@pytest.fixture
def documents(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns named like results and working columns."""
    long = sentence(1, 30_000)
    near = sentence(2, 200)
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \n\t ", "en", "a", 3),
        (4, near, "en", "a", 1),
        (5, near.upper(), "en", "b", 1),
        (5, near.upper(), "en", "b", 1),
        (6, near + " one two", "fr", "b", 1),
        (7, long, "en", "c", 1),
        (8, long + " tail", "en", "d", 1),
        (9, "two words", "en", "a", 1),
        (10, "two words", "fr", "b", 1),
        (None, "no id here at all", "en", None, 1),
        (11, sentence(3, 60), "de", "c", 1),
        (12, "!!! 123 ???", "de", "c", 1),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def clashing(documents):
    """The documents with columns named like results and like working columns."""
    from pyspark.sql import functions as F

    names = "kept keep_id score lang_pred _row _box _hash _text _owner spans KEPT_TEXT host _class ids node label".split()
    return documents.select("*", *[F.lit("x").alias(c) for c in names])


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)

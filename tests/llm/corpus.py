"""Rows that the tests of the text operators share."""

from __future__ import annotations

import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
VOCABULARY = "the of and to in is that it was for on are with as they be at one have this from by hot word but what some we can out other were all there when up use your how said an each she".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(VOCABULARY) + rng.choice(["", "", "", "s", "ed", "ing"]) for _ in range(n))


#: Null, empty, blank, very long, repeated rows, null ids and columns.
ODD = [
    (1, None, "en", "a", None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", None, None, 4),
    (4, "x" * 300_000, "en", "a", 300_000),
    (5, prose(1, 60_000), "en", "b", 1),
    (6, prose(2, 80), "en", "b", 1),
    (6, prose(2, 80), "en", "b", 1),
    (None, prose(3, 80), "de", None, None),
    (7, "é中😀 ß  x ▁▁ <|endoftext|>\x00", "zz", "c", 12),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def clashing(docs, *names):
    """The rows with further columns of names that the operators use themselves."""
    from pyspark.sql import functions as F

    return docs.withColumns({name: F.lit(7) for name in names})

import random

import pytest

WORDS = [f"w{i}" for i in range(400)]


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and white texts, repeated rows, ties, non-ASCII, one long text."""
    rng = random.Random(5)
    passage = prose(rng, 60)
    long = prose(rng, 9000)
    line = "This very line of forty and more characters stands in many documents"
    rows = [(1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, "One two", "b"), (4, "One two", "b"), (None, "null id " + passage, "b"), (5, passage, "c"), (6, prose(rng, 50) + " " + passage + "\n" + line, "c"), (7, "é è ñ ß " * 20, "c"), (8, long, "a"), (9, long + " tail", "a"), (10, "x " * 200, None)]
    rows += [(20 + i, f"start {i}\n  {line.upper()}\t\nend {i}", "ab"[i % 2]) for i in range(6)]
    rows += [(40 + i, prose(rng, 120), f"s{i % 5}") for i in range(30)]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """With columns whose names operators could trip over."""
    rows = [(i, t, s, 7, "x", 1) for i, t, s in odd_rows]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size int, id string, n int").repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, lang string, n_chars long")

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def make(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="session")
def words():
    r = random.Random(5)
    return ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9))) for _ in range(3000)]


@pytest.fixture(scope="session")
def odd_rows(words):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows."""
    r = random.Random(6)
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    base = text(60)
    return [
        (1, None, "a"), (2, "", "a"), (3, " \t\n ", None), (4, base, "b"), (4, base, "b"), (5, base, None), (None, base, "b"), (None, None, None), (6, base + " extra", "c"),
        (7, text(30_000), "a"), (8, "one", "b"), (9, "x\n" * 40, "a"), (10, "é ü 漢字 " * 20, "c"), (11, text(200), "a"), (12, text(200), "a"), (13, "a b", "b"), (14, "a b", "b"),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return make(spark, odd_rows)


@pytest.fixture(scope="session")
def clashing(odd_docs):
    """Extra columns with the names that operators make, and with known names in other case."""
    from pyspark.sql import functions as F

    extra = ["size", "score", "kept", "key", "fp", "root", "lines", "h1", "TEXT", "Doc_id", "n_tokens", "count", "bucket", "__c0", "pattern"]
    return odd_docs.select("*", *[F.lit(7).alias(x) for x in extra])


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, words):
    parts = ["the", "of", "and", "ra", "ti", "on", "shen", "éta", "ßor", "al"]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(words))


@pytest.fixture(scope="session")
def odd_rows():
    """Documents with nulls in every column, empty and long texts, repeats, near copies and shared lines."""
    rng = random.Random(5)
    base = prose(rng, 120)
    rows = [
        (0, base, "en", "b", 1),
        (1, base, "en", "b", 1),
        (2, base + " more", "en", None, None),
        (3, " ".join(base.split()[:100]), None, "a", 1),
        (4, None, "en", "a", 1),
        (5, "", "fr", "a", 1),
        (6, " \t\n ", "fr", "a", 1),
        (None, base, "en", "a", 1),
        (None, None, None, None, None),
        (7, "one", "fr", "c", 1),
        (8, "One two", "fr", "c", 1),
        (9, "one TWO", "fr", "c", 1),
        (10, prose(rng, 30_000), "fr", "c", 1),
        (11, "repeated row here now", "fr", "b", 1),
        (11, "repeated row here now", "fr", "b", 1),
        (12, "one id", "fr", "b", 1),
        (12, "two texts under one id " + prose(rng, 40), "fr", "b", 1),
        (13, "mail a.b@mail.example.com ip 10.0.0.256 10.0.0.255 card 4242 4242 4242 4242 call +1 (555) 010-2030 now", "en", "a", 1),
    ]
    for k in range(14, 40):
        rows.append((k, prose(rng, rng.randint(5, 80)) + "\n  Shared LINE \n" + prose(rng, 9), rng.choice(["en", "fr"]), rng.choice("abc"), 1))
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def clashing(odd_docs):
    """The same rows with columns named like those that the operators use inside."""
    from pyspark.sql import functions as F

    names = ["rep", "node", "label", "key", "kept", "row", "th", "kid", "rid", "size", "copies", "_doc", "_text", "kept_text", "batch", "_bad", "count", "source_size"]
    return odd_docs.select("*", *[F.lit("x").alias(n) for n in names])

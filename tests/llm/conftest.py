import random

import pytest


@pytest.fixture(scope="session")
def prose():
    """Texts over a small vocabulary, by seed and number of words."""

    def make(seed, n, vocabulary=400):
        rng = random.Random(seed)
        return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))

    return make


@pytest.fixture(scope="session")
def awkward(spark, prose):
    """Documents with NULLs, empty and long texts, repeated rows, equal ids, odd white space, and clashing columns."""
    long = prose(1, 30_000)
    rows = [
        (1, prose(2, 60), "en", "src1", 5),
        (2, prose(2, 60), "en", "src1", 5),
        (2, prose(2, 60), "en", "src1", 5),
        (3, prose(2, 58) + " changed end", None, "src2", None),
        (4, "", "de", "src3", 0),
        (5, None, "de", None, 0),
        (None, prose(2, 60), "fr", "src1", 1),
        (6, long, "en", "src0", 1),
        (7, long[: len(long) // 2], "en", "src0", 1),
        (8, "  \t\n ", "es", "src0", 1),
        (9, "É à b ÄÖ\x0bx\r\ny " + prose(2, 60), "fr", "src9", 1),
        (10, "same " * 500, "en", "src0", 1),
        (11, "one", "en", "odd", 1),
        (12, prose(3, 40), "en", "src1", 1),
        (12, prose(4, 40), "en", "src1", 1),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", "'mine' AS score", "1 AS n_words", "2 AS spans", "3 AS word", "array(1) AS licenses", "4 AS node", "5 AS copies", "6 AS domain", "7 AS text_key")

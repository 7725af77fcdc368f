import random

import pytest


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and long texts, repeated rows, columns that clash with ours."""
    rng = random.Random(4)
    words = ["alpha", "beta", "gamma", "Delta", "épée", "naïve", "ß", "1234", "x"]
    long = " ".join(rng.choice(words) + str(rng.randrange(50)) for _ in range(6000))
    prose = " ".join(rng.choice(words) for _ in range(120))
    rows = [
        (1, None, "a"), (2, "", "a"), (3, " \t\n", None), (4, "one", "b"), (5, "one two", "b"), (6, "one two three four", "b"),
        (7, prose, "a"), (8, prose, "b"), (8, prose, "b"), (9, prose.upper(), None), (None, prose, "a"), (None, None, None),
        (10, prose + " tail", "c"), (11, long, "c"), (12, long + " end of it", "c"), (13, "w" * 5000, "a"), (14, "ONE two", "b"),
    ]
    extra = [(i, t, s, "x", 1, None, i, 0.5, True) for i, t, s in rows]
    schema = "doc_id long, text string, source string, key string, n int, lang string, n_chars long, score double, kept boolean"
    return spark.createDataFrame(extra, schema)

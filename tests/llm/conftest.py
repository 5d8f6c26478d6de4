import random

import pytest

WORDS = "the of and river stone light under walks seven green over paper house cold with for moon glass seldom bright".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def edited(rng, text, share):
    return " ".join("edit%d" % rng.randrange(10 ** 6) if rng.random() < share else w for w in text.split(" "))


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text, lang, source): near and exact copies, ties, nulls, empty, short and long texts, repeated rows."""
    rng = random.Random(5)
    texts = [prose(rng, rng.randrange(6, 120)) for _ in range(25)]
    texts += [edited(rng, rng.choice(texts[:6]), share) for share in (0.0, 0.01, 0.02, 0.03, 0.05) for _ in range(8)]
    base = prose(rng, 150)
    texts += [base] + [edited(rng, base, 0.012) for _ in range(40)]
    texts += [None, "", "   ", "one", "One", "one two three four", "one  two\nthree four", prose(rng, 30_000)]
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["hot", "hot", "rare", None])) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows + [rows[0], rows[1], (None, texts[3], "en", "hot"), (None, None, None, None)]


SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture
def docs(spark, corpus):
    """The corpus with columns whose names the operators use themselves."""
    return spark.createDataFrame(corpus, SCHEMA).selectExpr("*", "1 AS n", "'x' AS row", "2.5D AS score", "length(text) AS n_chars", "0 AS root").repartition(5)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA + ", n_chars long")

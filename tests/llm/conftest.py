import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id long, row long, key string, "
          "label int, bucket string, weight double, split string, rank int, score string, h int, w string")


def row(doc_id, text):
    return (doc_id, text, None, None, None, 7, None, "k", 1, "b", None, "s", 0, "x", None, "w")


@pytest.fixture(scope="session")
def prose():
    """Seeded sentences: words(n, seed) -> text."""
    def make(n, seed, vocabulary=400):
        rng = random.Random(seed)
        words = [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
        return " ".join(words).capitalize() + "."
    return make


@pytest.fixture(scope="session")
def edge_docs(spark, prose):
    """Nulls, empty and very long texts, repeated rows and clashing column names."""
    rows = [row(i, prose(60, i)) for i in range(20)]
    rows += [row(None, prose(60, 99)), row(None, None), row(30, None), row(31, ""), row(31, ""), row(32, " \n\t "),
             row(33, prose(60, 3)), row(33, prose(60, 3)), row(34, "one two"), row(35, "One two"),
             row(36, " ".join(prose(2000, k) for k in range(30))), row(37, "x" * 200_000),
             row(38, "a b İstanbul ẞ é ﬁ <|endoftext|> don't 你好 \U0001f600")]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def edge_labels(spark):
    return spark.createDataFrame(
        [(i, i % 2, (i // 2) % 2) for i in range(20)] + [(None, 1, 0), (3, None, None), (5, 0, 1), (5, 1, 0), (77, 1, 1)],
        "doc_id long, quality int, toxic int")

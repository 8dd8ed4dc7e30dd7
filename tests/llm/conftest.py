import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, node string, head long, a string, tag string, "
    "digest int, bucket string, size string, keep_doc long, pii_spans string, statistic_chars string"
)


def row(doc_id, text):
    return (doc_id, text, "en", "src0", None if text is None else len(text), "x", 7, None, "t", 3, "b", None, 9, "p", "s")


@pytest.fixture(scope="session")
def prose():
    """Random prose: ``prose(seed, words)``."""
    syllables = ["th", "er", "on", "an", "re", "the", "in", "tion", "é", "ß", "ing"]

    def make(seed, words):
        rng = random.Random(seed)
        return " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 5))) for _ in range(words))

    return make


@pytest.fixture(scope="session")
def awkward_rows(prose):
    """Nulls, empty and very long texts, equal texts, a repeated row, a null id."""
    texts = [
        (1, prose(1, 80)), (2, prose(1, 80)), (3, None), (4, ""), (5, " \n\t "), (6, "one"), (7, "One"), (8, prose(2, 30_000)),
        (9, "word " * 300), (10, prose(3, 120)), (11, prose(3, 119) + " changed"), (None, prose(4, 60)), (None, None), (12, "é" * 150),
    ]
    return [row(*t) for t in texts] + [row(10, prose(3, 120))]


@pytest.fixture(scope="session")
def awkward(spark, awkward_rows):
    """The rows with columns named like those that operators use inside."""
    return spark.createDataFrame(awkward_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def make_docs(spark):
    return lambda texts: spark.createDataFrame([row(*t) for t in texts], SCHEMA)

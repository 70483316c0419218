import random

import pytest

VOCABULARY = ["ba", "be", "bi", "bo", "bu", "da", "de", "di", "do", "du", "fa", "fe", "fi", "fo", "fu", "Ga", "Ge", "Été", "öl"]


@pytest.fixture(scope="session")
def prose():
    """A maker of seeded word sequences."""
    def make(seed, n):
        draw = random.Random(seed)
        return " ".join("".join(draw.choice(VOCABULARY) for _ in range(draw.randint(1, 3))) for _ in range(n))
    return make


@pytest.fixture()
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with columns whose names operators use inside."""
    def make(rows):
        kind = "doc_id bigint, text string, spans string, doc string, c0 int, id int, score int, digest int, tokens string"
        return spark.createDataFrame([(i, t, None, "x", 7, 1, 2, 3, "y") for i, t in rows], kind)
    return make

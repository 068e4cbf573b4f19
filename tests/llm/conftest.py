import random

import pytest

EDGES = [None, "", " \t\n ", "a", "Ω", "123 456", "the same the same the same " * 40, "x" * 70_000]


@pytest.fixture(scope="session")
def prose():
    """Random sentences of one invented language each."""
    def make(seed: int, words: int, syllables=("th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha")) -> str:
        rnd = random.Random(seed)
        return " ".join("".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4))) for _ in range(words))

    return make


@pytest.fixture()
def docs(spark):
    """Texts, or (doc_id, text) pairs, as a table with columns whose names operators use too."""
    def make(texts, parts: int = 2):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame(
            [(*r, "en", "s", 1.0, "q") for r in rows],
            "doc_id bigint, text string, lang string, source string, score double, spans string").repartition(parts)

    return make

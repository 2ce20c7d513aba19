from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """A documents table of (doc_id, text) pairs or rows, dealt over several partitions."""

    def build(rows, parts: int = 3):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts)

    return build


@pytest.fixture
def rng():
    return random.Random(5)


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


ODD_TEXTS = [None, "", "   \n\t ", "one", "Ünïcode wörd", "x" * 30_000, "a b c d e\n" * 4000]

from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Small tables of documents: (id, text) pairs, with columns whose names operators use themselves."""

    def docs(rows):
        full = [(i, t, "en", "s", len(t) if t else 0, "x", "y") for i, t in rows]
        return spark.createDataFrame(full, DOCS + ", words string, class string")

    return docs


@pytest.fixture(scope="session")
def prose():
    """Texts of invented words, the same for every run."""

    def text(seed: int, n: int) -> str:
        rng = random.Random(seed)
        return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))

    return text

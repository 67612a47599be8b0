"""Fixtures of the training-data operators: small frames and awkward rows."""

from __future__ import annotations

import random

import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Builds a documents frame from (doc_id, text[, lang[, source]]) rows."""

    def build(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s0",
                 None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(3)

    return build


@pytest.fixture
def random_words():
    def words(rng: random.Random, n: int, vocabulary: int = 500) -> list[str]:
        return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]

    return words

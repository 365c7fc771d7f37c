"""Small document tables with the awkward cases every operator must take."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, row string, score double, size string"


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


def rows_of(texts, sources=("b", "a", None)):
    """Rows of (doc_id, text); the last columns clash with names used inside the operators."""
    return [
        (i, t, "en", sources[n % len(sources)], len(t or ""), 7, "x", 0.5, "s") for n, (i, t) in enumerate(texts)
    ]


@pytest.fixture(scope="session")
def table(spark):
    def make(texts, **kwargs):
        return spark.createDataFrame(rows_of(texts, **kwargs), SCHEMA)

    return make


@pytest.fixture(scope="session")
def awkward():
    """Nulls, empty and blank texts, repeated rows, equal texts, near copies, one long text."""
    base = prose(1, 300)
    near = base.split()
    near[150] = "changed"
    passage = prose(2, 70)
    return [
        (5, base),
        (3, " ".join(near)),
        (9, base.upper()),
        (9, base.upper()),
        (None, base),
        (11, None),
        (12, ""),
        (13, " \t\n\x0b\f\r "),
        (14, "one two"),
        (15, "One  TWO"),
        (16, f"{prose(3, 80)} {passage} {prose(4, 60)}"),
        (17, f"{prose(5, 90)} {passage}"),
        (18, f"{passage} {passage}"),
        (19, "é" * 150 + " ü " + "é" * 150),
        (20, prose(6, 30_000, 5000)),
        (21, prose(6, 30_000, 5000) + " tail"),
        (22, "a" * 450),
        (23, "ÉCOLE ecole École"),
    ]

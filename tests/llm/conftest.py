from __future__ import annotations

import numpy as np
import pytest

SAME = "one text of several plain words that comes up again and again"


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    from leafmill.llm.common import ship

    ship(spark)


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns named like inner ones."""
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(40_000))
    rows = [
        (None, None), (1, ""), (2, " \t\n\x0b"), (3, "word"), (4, long), (5, SAME), (5, SAME), (6, SAME + " "),
        (None, SAME), (7, "z" * 100_000), (8, "a\nb\n\na\n"), (9, "naïve 😀 text ½ <|endoftext|>"),
    ]
    return spark.createDataFrame(
        [(i, t, 1, True, "x", 0, 0.5, None) for i, t in rows],
        "doc_id long, text string, rid int, kept boolean, sha string, n int, score double, label string",
    )


@pytest.fixture(scope="session")
def empty(edge):
    return edge.limit(0)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def prose():
    """A maker of random texts: words from a small, skewed vocabulary."""
    rng = np.random.default_rng(7)
    vocabulary = ["".join(rng.choice(list("abcdeiorst"), rng.integers(2, 8))) for _ in range(400)]
    weight = 1 / np.arange(1, 401)
    weight /= weight.sum()

    def make(n: int) -> str:
        words = rng.choice(vocabulary, n, p=weight)
        return " ".join(w + ("\n" if rng.random() < 0.08 else "") for w in words)

    make.rng = rng
    return make

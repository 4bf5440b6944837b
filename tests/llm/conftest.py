import random

import pytest


def word_bag(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choices("abcdeé", k=rng.randint(1, 6))) for _ in range(n)]


@pytest.fixture(scope="session")
def hard_texts():
    """Null, empty, blank, very long, odd and repeated texts."""
    rng = random.Random(11)
    words = word_bag(rng, 40)
    rows = [" ".join(rng.choices(words, k=rng.choice([1, 5, 40, 200]))) for _ in range(40)]
    rows += [None, "", " \t\n\r\v\f", "a\x1fb c\x85d", "Ünïcode ΑΣ ǅ é 가", "word " * 30_000, "x" * 200_000, rows[0], rows[0]]
    return rows


@pytest.fixture(scope="session")
def hard_docs(spark, hard_texts):
    """The texts with null and repeated ids, and columns named like results."""
    clash = "n_words string, n_tokens string, kept string, redacted string, spans string, fp string, score string, hit_spans string"
    rows = [(None if i == 3 else 7 if i == 8 else i, t, *["own"] * 8) for i, t in enumerate(hard_texts)]
    return spark.createDataFrame(rows, f"doc_id long, text string, {clash}").repartition(3)

import random

import pytest

LONG = {
    "one word": "a" * 40_000, "digits": "1" * 40_000, "periodic": "Annt " * 8_000, "dots": "a@b" + ".c" * 9_000,
    "spaced digits": "1 " * 9_000 + "4111 1111 1111 1111", "plus": "+1" + " (" * 9_000, "lines": "same line here\n" * 2_000,
}


def prose(rng: random.Random, n: int) -> str:
    syllables = ["an", "ter", "lo", "mi", "es", "tion", "ka", "ru", "ve", "sho", "nd", "pli"]
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """(doc_id, text): nulls, empties, long texts, ties, repeated rows."""
    rng = random.Random(3)
    base = prose(rng, 80)
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (None, base), (None, None), (4, base), (4, base), (5, base.upper()), (6, base + " end"),
        (7, "one"), (8, "One"), (9, "one two"), (10, prose(rng, 300)), (11, "é ü ñ ß İ \U0001f600 mail x.y@z.org, +1 (375) 555-4393."),
        (12, "a@b.c_d@e.f ip 1.2.3.4.5.6.7.8 999.1.1.1 card 4111-1111 1111 1111 4111111111111112 +123"),
    ]
    return rows + [(100 + i, t) for i, t in enumerate(LONG.values())]


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    """The rows with further columns whose names the operators use themselves."""
    extra = "score double, n_words long, key string, row long, cls string, n int, label int, lang string, hit string, start int"
    return spark.createDataFrame(
        [(d, t, 0.5, 7, "k", 1, "c", 2, 1, "en", "h", 0) for d, t in edge_rows], f"doc_id long, text string, {extra}"
    ).repartition(3)


@pytest.fixture(scope="session")
def empty(edge):
    return edge.limit(0)

import pytest

DOCS = "doc_id long, text string, source string, length long, sequence_id string, `row` int, node string, key int"


@pytest.fixture
def documents(spark):
    """Documents with nulls, empty and long texts, repeated rows, and columns whose names operators use."""

    def make(texts, sources=None):
        rows = [
            (i, t, (sources or {}).get(i, f"s{i % 3}"), i, f"q{i}", i, "n", None) for i, t in enumerate(texts)
        ]
        rows += [(None, "a text without an id", None, None, None, None, None, None)] * 2 + [rows[0]] * 2 if rows else []
        return spark.createDataFrame(rows, DOCS)

    return make


WORDS = [a + b for a in "bdfglmnprt" for b in ("a", "e", "ino", "orum", "undi", "ape", "sti")]


@pytest.fixture
def prose():
    """Seeded invented prose of n words."""
    import random

    def make(seed, n):
        r = random.Random(seed)
        return " ".join(r.choice(WORDS) + r.choice(WORDS) for _ in range(n))

    return make


@pytest.fixture
def texts(prose):
    return [
        "One, two; three.",
        "",
        " \t\n ",
        None,
        prose(1, 30),
        prose(2, 60) + "\n" + prose(3, 70) + "\n\n" + prose(3, 70),
        "x" * 20_000,
        prose(4, 9_000),
        "¡Ñandú çà! 𝄞 ﬁn \x1c\x85 \xa0 Σας",
    ]

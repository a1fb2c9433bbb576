import random

import pytest

WORDS = [a + b for a in ("ka", "lo", "mi", "ne", "pu", "ra", "so", "ti") for b in ("bel", "dor", "fin", "gan", "hul", "jek", "mos", "nar", "pim", "ros")]


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + ("." if r.random() < 0.1 else "") for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, copies, and columns whose names operators might use."""
    long, copy = prose(1, 30_000), prose(2, 400)
    near = copy.split()
    near[200] = "changed"
    rows = [
        (1, "a", long), (2, "a", copy), (3, "b", copy), (4, None, " ".join(near)), (5, "b", None), (6, None, ""), (7, "c", "  \t\n "),
        (8, "c", "one two"), (8, "c", "one two"), (8, "c", "ONE two"), (None, "a", prose(3, 120)), (None, None, None), (9, "é", "naïve café 東京 " + prose(4, 80)),
        (10, "b", prose(5, 60) + " " + copy[:700] + " " + prose(6, 60)), (11, "a", "x" * 50_000), (12, "a", prose(7, 300)), (12, "a", prose(7, 300)),
    ]
    rows = [(i, t, "en", s, n, "k", n % 3, None) for n, (i, s, t) in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, _at int, _key string, _size int, _text string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def all_null(spark):
    return spark.createDataFrame([(None, None, None, None)] * 3, "doc_id bigint, text string, lang string, source string")

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


def words(rnd, n, vocabulary=400):
    return [f"w{rnd.randrange(vocabulary)}" for _ in range(n)]


def odd_rows():
    """(doc_id, text, source): nulls, empties, ties, repeated rows, a long text, copies and near copies."""
    rnd = random.Random(7)
    base = words(rnd, 120)
    near = base[:60] + ["changed"] + base[61:]
    shared = words(rnd, 55)
    long = words(rnd, 30_000, 5000)
    rows = [
        (1, " ".join(base), "a"), (2, " ".join(base), "a"), (3, " ".join(near), "b"), (4, "  " + " ".join(base).upper() + "\n", None),
        (5, " ".join([*words(rnd, 40), *shared, *words(rnd, 40)]), "b"), (6, " ".join([*words(rnd, 90), *shared]), "a"), (7, " ".join(shared), "c"),
        (8, None, "a"), (9, "", "a"), (10, " \t\n ", None), (11, "one two", "b"), (12, "ONE two", "b"), (13, "one", "c"),
        (14, " ".join(long), "c"), (15, " ".join(long[:29_000]), "d"), (16, "x " * 200, "d"), (17, "x " * 300, "a"), (17, "x " * 300, "a"),
        (None, " ".join(base), "a"), (None, None, None), (18, "naïve café 中文 \U0001f600 text here", "e"), (19, " ".join(base[:59]), "a"),
    ]
    rows += [(100 + i, " ".join(words(rnd, 5 + 13 * i)), "abc"[i % 3]) for i in range(12)]
    rows += [(200 + i, " ".join(base[:50] + words(rnd, 3) + base[53:]), "n") for i in range(20)]  # a group of near copies
    return rows


@pytest.fixture(scope="session")
def odd():
    return odd_rows()


@pytest.fixture(scope="session")
def odd_docs(spark, odd):
    """With further columns whose names the operators use themselves."""
    more = [(*r, i, "k", 1.5, b"x", None, "z", i) for i, r in enumerate(odd)]
    return spark.createDataFrame(more, "doc_id long, text string, source string, rank int, key string, size double, sig binary, copies string, row string, ord int").repartition(5)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, lang string, n_chars long")

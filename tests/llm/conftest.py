import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, doc string, digest string, key string"


@pytest.fixture(scope="session")
def words():
    rng = random.Random(5)
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(400)]


@pytest.fixture(scope="session")
def corpus(words):
    """(doc_id, text) with copies, near copies, nulls, empty and long texts, repeated rows."""
    rng = random.Random(9)
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(3, 120))) for _ in range(60)]
    rows = list(enumerate(base))
    n = len(rows)
    for k in range(25):  # near copies of one text and of others
        w = base[0 if k < 15 else k].split()
        for _ in range(1 + k % 4):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((n + k, " ".join(w)))
    rows += [(100, base[3]), (101, base[3].upper()), (102, "  ".join(base[3].split())), (103, None), (104, ""), (105, " \t\n"), (106, "one two"), (107, "One  two"), (108, " ".join(words * 12)), (109, "a" * 5000), (7, base[7])]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    rows = [(i, t, [None, "en", "fr"][i % 3], [None, "s1", "s2", "s3"][i % 4], len(t or ""), "x", "y", "z") for i, t in corpus]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)

"""What is counted, sampled and compared whole, from the definitions."""

import random
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from chronogrid.llm import line_templates as L, quality as Q, toxicity as T


def dropped(texts):
    """Lines (text, number) of templates that at least RECURS texts have, from the definition."""
    leaves = defaultdict(set)
    for k, t in texts.items():
        for number, line in enumerate(t.split("\n")):
            if w := L.masked(line):
                leaves[len(w), *w[: L.DEPTH]].add((k, number, tuple(w)))
    out = set()
    for lines in leaves.values():
        having = Counter((at, x) for at, x, _ in {(at, x, k) for k, _, w in lines for at, x in enumerate(w)})
        kept = {w: tuple((at, x) for at, x in enumerate(w) if x != L.FIELD and having[at, x] >= L.RECURS) for _, _, w in lines}
        texts_of = defaultdict(set)
        for k, _, w in lines:
            texts_of[kept[w]].add(k)
        out |= {(k, n) for k, n, w in lines if len(kept[w]) >= L.CONSTANT * len(w) and len(texts_of[kept[w]]) >= L.RECURS}
    return out


def lost(spark, texts):
    rows = L.without_templates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    return {r.doc_id: r.n_dropped for r in rows if r.n_dropped}


def test_five_variants_in_one_text_are_no_template(spark):
    texts = {0: "\n".join(f"status of job {x} done now with care" for x in "abcde")}
    texts |= {k: f"status of job {x * 5}" for k, x in enumerate(["p ", "q ", "r ", "s "], 1)}
    assert dropped(texts) == set()
    assert lost(spark, texts) == {}


def test_documents_of_templates_are_distinct(spark):
    rng = random.Random(12)
    line = lambda: " ".join(["a", "b", rng.choice("cd"), rng.choice("ef"), rng.choice("gh"), *("".join(rng.choices("mnopqr", k=4)) for _ in range(2)), rng.choice("012")])
    texts = {k: "\n".join(line() for _ in range(rng.choice([1, 1, 2, 9]))) for k in range(16)}
    want = dropped(texts)
    assert 0 < len(want) < sum(t.count("\n") + 1 for t in texts.values())
    assert lost(spark, texts) == Counter(k for k, _ in want)


def test_one_long_text_does_not_empty_the_toxic_sample(spark, monkeypatch):
    monkeypatch.setattr(T, "MOST_CHARS", 2000)
    monkeypatch.setattr(T, "train", lambda texts, classes: list(zip(texts, classes, strict=True)))
    rows = [(i, "x" * (1900 if i % 5 == 0 else 20), i % 2) for i in range(40)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = T.fit(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"))
    assert sorted(got) == sorted((t, y) for i, t, y in rows if len(t) == 20 and zlib.crc32(str(i).encode()) % 5)


def test_unlabelled_documents_are_found_behind_labelled_ones(spark, monkeypatch):
    monkeypatch.setattr(Q, "LABELLED", 6)
    monkeypatch.setattr(Q, "UNLABELLED", 4)
    monkeypatch.setattr(Q, "co_train", lambda features, meta, y: list(y))
    docs = spark.range(300).selectExpr("id AS doc_id", "'a b' AS text", "'en' AS lang", "'s' AS source", "3L AS n_chars")
    last = [r.doc_id for r in docs.orderBy(F.xxhash64("doc_id", F.lit(3)).desc()).limit(5).collect()]
    labels = docs.where(~F.col("doc_id").isin(last)).selectExpr("doc_id", "CAST(doc_id % 2 AS int) AS quality")
    got = Q.fit(docs, labels)
    assert got.count(-1) == 4 and len(got) == 10

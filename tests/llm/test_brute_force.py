"""Scores and the pipeline from their definitions, row by row in plain Python."""

import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from chronogrid.llm import decontaminate as D, line_templates as L, mixing as M, quality as Q, toxicity as T
from chronogrid.llm.queries import tokenizer_path
from chronogrid.llm.shingles import word_hashes
from tests.llm.test_jaccard_join import brute
from tests.llm.test_others import nearest

SPACE = "\x09\x0a\x0b\x0c\x0d\x20"


def margin(model, unit):
    """The weight of every placing of four characters within the window, one by one."""
    chars = [43, *(int(T.CODES[ord(c)]) if ord(c) < len(T.CODES) else 27 + ord(c) % 16 for c in unit), 44]
    chars = [c for c in chars if c]
    total = 0.0
    for i in range(len(chars)):
        for m in range(i + 3, min(len(chars), i + T.WINDOW)):
            for j in range(i + 1, m - 1):
                for k in range(j + 1, m):
                    number = chars[i] * 45**3 + chars[m] + (chars[j] * 45 + chars[k]) * 45
                    total += T.DECAY ** (m - i + 1) * float(model.table[(number * 0x9E3779B1 >> 12) & ((1 << 20) - 1)])
    return total / float(T.norms(np.array([len(chars)]))[0]) + model.bias


def toxic_score(model, text, known):
    low = (text or "").lower()
    units = low.split()
    runs = re.findall(r"(?<!\S)\S(?:\s\S(?!\S)){2,}", low) if any(len(u) == 1 for u in units) else []
    units += ["".join(r.split()) for r in runs]
    margins = sorted((known.setdefault(u, margin(model, u)) if u not in known else known[u] for u in units), reverse=True)[:3]
    top = [max(x, model.floor) for x in margins] + [model.floor] * (3 - len(margins))
    z = sum(w * x for w, x in zip(model.curve, [*top, math.log1p(len(units)), 1.0], strict=True))
    return 1 / (1 + math.exp(-max(-35, min(35, z))))


@pytest.fixture(scope="module")
def toxic_model(words):
    rng = random.Random(6)
    texts, labels = [], []
    for i in range(240):
        w = [rng.choice(words) for _ in range(rng.randint(5, 40))]
        if i % 3 == 0:
            w[rng.randrange(len(w))] = rng.choice(["grobnik", "vashtul", "kremplo!"])
        texts.append(" ".join(w))
        labels.append(int(i % 3 == 0))
    return T.train(texts, labels)


def test_toxicity_scores_against_every_placing(spark, docs, corpus, toxic_model):
    known = {}
    got = sorted((r.doc_id, round(r.score, 6), r.predicted) for r in T.score(docs, toxic_model).collect())
    want = [(i, toxic_score(toxic_model, t if t is None or len(t) < 5000 or " " in t else t, known)) for i, t in corpus]
    assert [r[0] for r in got] == sorted(i for i, _ in want)
    for (i, a, p), (j, b) in zip(got, sorted((i, round(s, 6)) for i, s in want), strict=True):
        assert i == j and abs(a - b) < 2e-6 and p == int(a >= 0.5)


def test_toxicity_curve_is_fitted_on_unseen_texts(words):
    """A class whose every text has a word of its own can be learnt by heart; on unseen texts it tells nothing."""
    rng = random.Random(2)
    texts = [" ".join(rng.choice(words) for _ in range(30)) for _ in range(160)]
    labels = [k % 2 for k in range(160)]
    texts = [f"{t} {''.join(rng.choices('qwxyz', k=9))}" if y else t for t, y in zip(texts, labels, strict=True)]
    model = T.train(texts, labels)
    scores = model.score(T._evidence(model, {}, [" ".join(rng.choice(words) for _ in range(30)) for _ in range(50)]))
    assert scores.max() < 0.9


def test_held_out_recall_on_the_larger_tables(spark):
    sf = "/root/testdata/sf0.1"
    documents, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    got = T.score(documents, T.fit(documents, labels)).where("held_out").join(labels, "doc_id").select("toxic", "predicted").collect()
    caught = sum(r.toxic and r.predicted for r in got)
    assert caught / sum(r.toxic for r in got) >= 0.9 and caught / sum(r.predicted for r in got) >= 0.9 and len(got) > 800


def test_an_id_labelled_both_ways_and_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(T, "train", lambda texts, classes: sorted(zip(texts, classes, strict=True)))
    monkeypatch.setattr(T, "MOST_TEXTS", 3)
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5][:6]
    docs = spark.createDataFrame([(i, f"text {i}") for i in ids] + [(ids[0], "again"), *[(ids[0], f"text {ids[0]}")] * 50], "doc_id long, text string")
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)] + [(ids[0], 1)], "doc_id long, toxic int")
    got = T.fit(docs, labels)
    assert len(got) == 5 and [y for t, y in got if t in ("again", f"text {ids[0]}")] in ([1], [])
    assert T.fit(docs.repartition(7), labels) == got


def text_row(text):
    """A text's features, measured one by one."""
    raw = (text or "").encode()
    words = re.findall(rb"[^\x09-\x0d\x20]+", raw)
    out, n, size = np.zeros(Q._BINS + Q._STATS), max(len(words), 1), max(len(raw), 1)
    hashes = []
    for w in words:
        h = int(word_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0])
        hashes.append(h)
        out[(h >> 40) % Q._BINS] += 1
    out[: Q._BINS] = np.sqrt(out[: Q._BINS] / n)
    kinds = [lambda c: 65 <= c <= 90, lambda c: 48 <= c <= 57, lambda c: c == 10, lambda c: c == 124, lambda c: c in b"!?", lambda c: c in b"%$&#*@=_~^+<>{}[]\\/", lambda c: c in b".,;:", lambda c: c == 32]
    for k, kind in enumerate(kinds):
        out[Q._BINS + k] = min(1.0, 4 * sum(map(kind, raw)) / size)
    lengths = [len(w) for w in words]
    mean = sum(lengths) / n
    out[Q._BINS + 8] = min(mean, 30) / 10
    out[Q._BINS + 9] = math.sqrt(min(max(sum(x * x for x in lengths) / n - mean**2, 0), 100)) / 10
    out[Q._BINS + 10] = len(set(hashes)) / n
    out[Q._BINS + 11] = sum(a == b for a, b in zip(hashes[1:], hashes[:-1], strict=True)) / n if hashes else 0
    out[Q._BINS + 12] = math.log1p(n) / 10
    out[Q._BINS + 13] = n <= 1
    return out


def test_quality_scores_against_features_one_by_one(spark, docs, corpus):
    rows = docs.select("doc_id", "text", "lang", "source", "n_chars").collect()
    rng = np.random.default_rng(4)
    text = np.array([text_row(r.text) for r in rows])
    assert np.allclose(text, Q.text_features(pa.array([r.text for r in rows], pa.string())), atol=1e-12)
    meta = Q.metadata_features([r.lang for r in rows], [r.source for r in rows], [r.n_chars for r in rows])
    labels = rng.integers(-1, 2, len(rows))
    model = Q.co_train(text, meta, labels)
    logistic = lambda z: 1 / (1 + math.exp(-max(-30, min(30, z))))
    line = lambda x, w: max(-30, min(30, sum(a * b for a, b in zip(x, w[:-1], strict=True)) + w[-1]))
    want = []
    for r, x, m in zip(rows, text, meta, strict=True):
        a = line(x, model.text) * model.text_curve[0] + model.text_curve[1]
        b = line(m, model.metadata) * model.metadata_curve[0] + model.metadata_curve[1]
        want.append((r.doc_id, round(logistic(model.joint[0] * a + model.joint[1] * b + model.joint[2]), 6), round(logistic(a), 6), round(logistic(b), 6)))
    got = [(r.doc_id, r.score, r.text_score, r.metadata_score) for r in Q.score(docs, model).collect()]
    assert np.allclose(sorted(got), sorted(want), atol=2e-6)


def test_views_hand_each_other_what_they_are_sure_of():
    """Each view knows a part that the other does not; only exchanged labels join them."""
    rng = np.random.default_rng(3)
    n = 900
    y = rng.integers(0, 2, n)
    text, meta = rng.normal(0, 0.3, (n, 4)), rng.normal(0, 0.3, (n, 3))
    text[:, 0] += 2 * y - 1
    meta[:, 0] += 2 * y - 1
    labels = np.where(np.arange(n) < 24, y, -1)
    with_pool, alone = Q.co_train(text, meta, labels), Q.co_train(text[:24], meta[:24], labels[:24])
    right = lambda m: float(((m.score(text, meta)[0] >= 0.5) == (y == 1)).mean())
    assert right(with_pool) > 0.97 and not np.allclose(with_pool.text, alone.text)
    again = Q.co_train(text, meta, labels)
    assert (again.text == with_pool.text).all() and (again.joint == with_pool.joint).all()


def test_held_out_quality_labels_are_not_read(spark):
    rng = random.Random(5)
    rows = [(i, f"{'good' if i % 2 else 'bad'} text {rng.random()}", "en", f"s{i % 3}", 20) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    fits = [Q.fit(docs, spark.createDataFrame([(i, (i % 2) ^ (flip and held(i))) for i in range(200)], "doc_id long, quality int")) for flip in (False, True)]
    assert (fits[0].text == fits[1].text).all() and (fits[0].joint == fits[1].joint).all()
    both = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(7, 0), (8, 1)], "doc_id long, quality int")
    one = Q.fit(docs.unionByName(docs), both)
    assert (one.text == Q.fit(docs.repartition(3), both.repartition(3)).text).all()


def test_templates_in_a_very_long_text(spark, words):
    rng = random.Random(1)
    long_ = "\n".join(" ".join(rng.choice(words) for _ in range(8)) for _ in range(30_000))
    texts = {0: long_ + "\nthis notice is on every page " + "\nx" * 5, **{k: f"this notice is on every page\nown {words[k]} {words[k + 40]}" for k in range(1, 8)}, 9: "w " * 200_000}
    rows = {r.doc_id: r for r in L.without_templates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert rows[0].n_lines == 30_006 and rows[0].n_dropped >= 1 and "this notice" not in rows[0].text
    assert all("this notice" not in rows[k].text and rows[k].n_dropped >= 1 for k in range(1, 8)) and rows[9].text == texts[9]


def test_items_of_one_character_and_repeated_items(spark):
    docs = spark.createDataFrame([(1, "xay"), (2, "bcd"), (3, None), (4, "A")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "a"), (7, "a"), (8, " \t")], "item_id long, text string")
    assert sorted(tuple(r) for r in D.matches(docs, items).collect()) == [(1, 7, 0, 2), (1, 7, 0, 2), (4, 7, 0, 1), (4, 7, 0, 1)]
    assert sorted(r.doc_id for r in D.decontaminated(docs, items).collect()) == [2, 3]


def test_pipeline_against_brute_force(spark, words, tmp_path, monkeypatch):
    """All stages over a small corpus with insults, near copies and benchmark passages, each from its definition."""
    rng = random.Random(21)
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(k, text(20)) for k in range(4)]
    rows = []
    for i in range(140):
        t = text(rng.randint(0, 90))
        if i % 7 == 0 and rows:
            w = rows[rng.randrange(len(rows))][1].split()
            if w:
                w[rng.randrange(len(w))] = rng.choice(words)
            t = "  ".join(w)
        if i % 5 == 1:
            t = f"{t} grobnik {text(3)}"
        if i % 11 == 3:
            hit = list(items[i % 4][1])
            hit[rng.randrange(len(hit))] = "#"
            t = f"{t} {''.join(hit).upper()} {text(4)}"
        rows.append((i, t, "en", f"s{i % 4}" if i % 9 else None, len(t)))
    rows += [(200, None, None, None, None), (201, "", "en", "s1", 0), (None, text(12), "en", "s1", 5)]
    for name, data, schema in (
        ("documents", rows, "doc_id long, text string, lang string, source string, n_chars long"),
        ("labels", [(r[0], 1, int("grobnik" in r[1])) for r in rows[:110]], "doc_id long, quality int, toxic int"),
        ("benchmark", items, "item_id long, text string"),
    ):
        spark.createDataFrame(data, schema).coalesce(2).write.parquet(f"{tmp_path}/{name}.parquet")
    sf, kept, known = str(tmp_path), {}, {}
    original = T.fit
    monkeypatch.setattr(T, "fit", lambda *a: kept.setdefault("model", original(*a)))
    got = P.run(spark, sf).collect()
    clean = [r for r in rows if toxic_score(kept["model"], r[1], known) < 0.5]
    assert 10 < len(rows) - len(clean) < 40
    component = {i: c for i, _, c in brute([r[:2] for r in clean])}
    single = [r for r in clean if r[0] is None or component[r[0]] == r[0]]
    normal = [D.normalise(t) for _, t in items]
    left = [r for r in single if not any(nearest(p, D.normalise(r[1] or ""))[0] <= int(len(p) * D.RATE) for p in normal if r[1])]
    assert len(left) < len(single) < len(clean)
    mixed = M.mix(spark.createDataFrame(left, "doc_id long, text string, lang string, source string, n_chars long"))
    taken = {}
    for r in mixed.taken().collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    texts = mixed.texts(spark.createDataFrame(left, "doc_id long, text string, lang string, source string, n_chars long")).collect()
    assert {i: sum(len(re.findall(rf"[^{SPACE}]+", r.text)) for r in texts if r.doc_id == i) for i in {r.doc_id for r in texts}} == {i: n for i, n in taken.items() if n}
    tokenizer = Tokenizer.from_file(tokenizer_path())
    tokenizer.encode_special_tokens = True
    want = sorted((r.doc_id is not None, r.doc_id or 0, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for r in texts if (ids := [*tokenizer.encode(r.text, add_special_tokens=False).ids, 0]))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [(r.doc_id is not None, r.doc_id or 0) for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order)

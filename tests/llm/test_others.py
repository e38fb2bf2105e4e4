"""Decontamination, toxicity, quality and line templates."""

import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from chronogrid.llm import decontaminate as D, line_templates as L, quality as Q, toxicity as T


def nearest(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row), row.index(min(row))


@settings(max_examples=400, deadline=None)
@given(st.text("abc", min_size=1, max_size=70), st.text("abc", max_size=40))
def test_myers_against_the_table(pattern, text):
    assert D.myers(pattern, text, 10_000) == nearest(pattern, text)


@pytest.fixture(scope="module")
def items(words):
    rng = random.Random(4)
    return [(i, " ".join(rng.choice(words) for _ in range(rng.randint(12, 30)))) for i in range(12)] + [(90, None), (None, "a b c"), (91, ""), (92, "tiny")]


@pytest.fixture(scope="module")
def held(words, items):
    """Documents that hold items after 0 to many edits."""
    rng = random.Random(8)
    rows = [(0, None), (1, ""), (2, "nothing here"), (3, "a TINY thing")]
    for k in range(60):
        text = list(items[k % 12][1])
        for _ in range(k % 20):
            at = rng.randrange(len(text))
            text[at : at + rng.randrange(2)] = [rng.choice("abcxyz")] * rng.randrange(2)
        rows.append((10 + k, " ".join(rng.choice(words) for _ in range(30)) + "  " + "".join(text).upper() + "\n" + rng.choice(words)))
    return rows


def test_matches_against_brute_force(spark, held, items):
    docs = spark.createDataFrame([(i, t, "x") for i, t in held], "doc_id long, text string, item_id string")
    table = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for i, t in held:
        for k, item in items:
            if k is not None and item:
                p = D.normalise(item)
                distance, at = nearest(p, D.normalise(t or ""))
                if t and distance <= int(len(p) * D.RATE):
                    want.add((i, k, distance, at))
    got = {tuple(r) for r in D.matches(docs, table).collect()}
    assert got == want and len({d for _, _, d, _ in got}) > 3
    kept = {r.doc_id for r in D.decontaminated(docs, table).collect()}
    assert kept == {i for i, _ in held} - {i for i, *_ in want}
    assert D.matches(docs.limit(0), table).collect() == [] and D.matches(docs, table.limit(0)).collect() == []
    assert D.decontaminated(docs, table.limit(0)).count() == len(held)


def test_many_items_are_matched_in_blocks(spark, held, items, monkeypatch):
    docs, table = spark.createDataFrame(held, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = {tuple(r) for r in D.matches(docs, table).collect()}
    monkeypatch.setattr(D, "BLOCK_CHARS", 400)
    assert {tuple(r) for r in D.matches(docs, table).collect()} == whole


INSULTS = ["grobnik", "vashtul", "kremplo"]


@pytest.fixture(scope="module")
def labelled(words):
    rng = random.Random(6)
    rows = []
    for i in range(400):
        w = [rng.choice(words) + rng.choice(["", "", ".", ","]) for _ in range(rng.randint(5, 60))]
        toxic = i % 3 == 0
        if toxic:
            for _ in range(rng.randint(1, 4)):
                w[rng.randrange(len(w))] = rng.choice(INSULTS) + rng.choice(["", ".", "!"])
        rows.append((i, " ".join(w), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def toxic_model(labelled):
    return T.train([t for _, t, _ in labelled], [y for *_, y in labelled])


def test_kernel_features_equal_the_sum_over_subsequences():
    def phi(unit):
        chars = [43, *(int(T.CODES[ord(c)]) for c in unit if T.CODES[ord(c)]), 44]
        out = {}
        for i in range(len(chars)):
            for j in range(i + 1, len(chars)):
                for k in range(j + 1, len(chars)):
                    for m in range(k + 1, min(len(chars), i + T.WINDOW)):
                        key = (chars[i], chars[j], chars[k], chars[m])
                        out[key] = out.get(key, 0) + T.DECAY ** (m - i + 1)
        return out, len(chars)

    units = ["stupid", "s.t.u.p.i.d", "stxupid", "a", "lo5er", "unrelated"]
    got = T._features(units, units)
    for a, u in enumerate(units):
        for b, v in enumerate(units):
            (x, n), (y, m) = phi(u), phi(v)
            want = sum(w * y.get(k, 0) for k, w in x.items()) / T.norms(np.array([n]))[0] / T.norms(np.array([m]))[0]
            assert got[a, b] == pytest.approx(want, abs=1e-6)


def test_toxicity_on_texts_it_has_not_seen(spark, labelled, toxic_model, words):
    rng = random.Random(77)
    rows = []
    for i in range(120):
        w = [rng.choice(words) for _ in range(40)]
        if i % 2:
            w[7] = rng.choice(INSULTS)
        rows.append((i, " ".join(w), "x"))
    got = {r.doc_id: r for r in T.score(spark.createDataFrame(rows, "doc_id long, text string, score string"), toxic_model).collect()}
    assert np.mean([got[i].predicted == i % 2 for i in range(120)]) > 0.95
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())


@pytest.mark.parametrize("written", ["g r o b n i k", "g.r.o.b.n.i.k", "Grob-nik!", "grobxnik", "gr0bnik"])
def test_gapped_insults_rank_over_clean_words(toxic_model, words, written):
    worst = max(toxic_model.margins(T.units_of(written)))
    assert worst > np.quantile(toxic_model.margins(words), 0.99)


def test_toxicity_edge_cases(spark, toxic_model):
    rows = [(None, None), (1, ""), (2, " \n"), (2, " \n"), (3, "grobnik " * 20_000), (4, "x" * 100_000)]
    got = T.score(spark.createDataFrame(rows, "doc_id long, text string"), toxic_model).collect()
    assert len(got) == 6 and {r.doc_id for r in got if r.predicted} == {3} and not [r for r in got if r.doc_id is None][0].held_out
    assert T.score(spark.createDataFrame([], "doc_id long, text string"), toxic_model).collect() == []
    assert {r.doc_id for r in T.accepted(spark.createDataFrame(rows, "doc_id long, text string"), toxic_model).collect()} == {None, 1, 2, 4}


def test_one_class_or_no_labels_give_one_score(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(8)], "doc_id long, text string")
    for rows in ([], [(i, 0) for i in range(8)], [(None, 1), (1, None)]):
        model = T.fit(docs, spark.createDataFrame(rows, "doc_id long, toxic int"))
        assert len({r.score for r in T.score(docs, model).collect()}) == 1


def test_held_out_labels_are_not_read(spark, labelled):
    docs = spark.createDataFrame([(i, t) for i, t, _ in labelled], "doc_id long, text string")
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    a = T.fit(docs, spark.createDataFrame([(i, y) for i, _, y in labelled], "doc_id long, toxic int"))
    b = T.fit(docs, spark.createDataFrame([(i, 1 - y if held(i) else y) for i, _, y in labelled], "doc_id long, toxic int"))
    assert (a.table == b.table).all() and (a.curve == b.curve).all() and a.bias == b.bias


def test_quality_by_co_training(spark, words):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(500):
        good = i % 4 != 0
        w = [rng.choice(words) for _ in range(rng.randint(10, 60))]
        text = " ".join(w) + "." if good else " | ".join(x.upper() + "!!" for x in w)
        rows.append((i, text, "en" if rng.random() < 0.8 else "fr", "good" if good == (rng.random() < 0.7) else "poor", len(text), "x"))
        if i % 3 == 0:
            labels.append((i, int(good)))
    rows += [(900, None, None, None, None, "x"), (901, "", "en", "s", 0, "x"), (901, "", "en", "s", 0, "x"), (None, "words " * 40_000, "en", "s", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    model = Q.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    got = Q.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert np.mean([r.kept == (r.doc_id % 4 != 0) for r in got if r.doc_id is not None and r.doc_id < 500]) > 0.97
    assert Q.score(docs.limit(0), model).collect() == []
    flat = Q.fit(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert len({r.score for r in Q.score(docs, flat).collect()}) == 1


def brute_templates(rows, recurs=L.RECURS):
    docs = {}
    for i, t in rows:
        docs[(i, t)] = [(n, tuple(L.masked(x))) for n, x in enumerate((t or "").split("\n")) if x.split()]
    count = {}
    for lines in docs.values():
        for tokens in {t for _, t in lines}:
            count[tokens] = count.get(tokens, 0) + 1
    place = lambda t: (len(t), t[: L.DEPTH])
    support = {}
    for t, n in count.items():
        for k, x in enumerate(t):
            support[place(t), k, x] = support.get((place(t), k, x), 0) + n
    shape = {t: tuple(x if x != L.FIELD and support[place(t), k, x] >= recurs else None for k, x in enumerate(t)) for t in count}
    shape = {t: s for t, s in shape.items() if sum(x is not None for x in s) / len(s) >= L.CONSTANT}
    total = {}
    for t, s in shape.items():
        total[place(t), s] = total.get((place(t), s), 0) + count[t]
    drop = {t for t, s in shape.items() if total[place(t), s] >= recurs}
    out = []
    for i, t in rows:
        gone = {n for n, x in docs[(i, t)] if x in drop}
        out.append((i, None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone), 0 if t is None else t.count("\n") + 1, len(gone)))
    return sorted(out, key=str)


def test_line_templates_against_brute_force(spark, words):
    rng = random.Random(12)
    rows = []
    for i in range(60):
        lines = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(0, 5))]
        if i % 2:
            lines.insert(rng.randint(0, len(lines)), f"Page view count {rng.randint(1, 900)} of {rng.choice(words)} today only")
        if i % 3 == 0:
            lines.append("All rights reserved.")
        rows.append((i, "\n".join(lines)))
    rows += [(70, None), (71, ""), (72, " \n\t\n"), (1, rows[1][1]), (73, "All rights reserved.\n" * 4), (None, "All rights reserved.")]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, leaf string, key string")
    got = sorted((tuple(r) for r in L.without_templates(docs).collect()), key=str)
    assert got == brute_templates(rows)
    assert sum(r[3] for r in got) > 40 and not any(re.search("Page view|All rights", r[1] or "") for r in got)
    assert L.without_templates(docs.limit(0)).collect() == []

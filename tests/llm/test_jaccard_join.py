import re
import random

import numpy as np
import pyarrow as pa
import pytest

from chronogrid.llm import jaccard_join as J
from chronogrid.llm.common import text_slices
from chronogrid.llm.components import components
from chronogrid.llm.shingles import shingle_sets


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return sorted((i, len(a), None if i is None else find(i)) for i, a in sets if i is not None)


def test_groups_against_brute_force(docs, corpus):
    got = sorted(map(tuple, J.jaccard_groups(docs).collect()))
    assert got == brute(corpus)


def test_null_id_is_no_partner(spark):
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e  f")]
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in J.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(None, 2, None), (1, 2, 1), (2, 2, 1)}


def test_empty_table(empty):
    assert J.jaccard_groups(empty).collect() == []


def test_dense_family_against_brute_force(spark, words):
    rng = random.Random(1)
    base = [rng.choice(words) for _ in range(60)]
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((i, " ".join(w)))
    got = sorted(map(tuple, J.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == brute(rows)


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8, 15, 16, 31, 40, 64, 90, 128, 300])
def test_every_similar_pair_shares_a_signature(size):
    rng = np.random.default_rng(size)
    for trial in range(150):
        extra = int(rng.integers(0, max(1, size // 3) + 1))
        x = rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2)
        common = int(rng.integers(int(np.ceil(0.75 * size)) if trial % 2 else size // 2, size + 1))
        y = np.concatenate([x[:common], rng.integers(0, 1 << 63, extra, dtype=np.uint64) * np.uint64(2)])
        x, y = np.unique(x), np.unique(y)
        inter = len(np.intersect1d(x, y))
        if not len(y) or 4 * inter < 3 * (len(x) + len(y) - inter):
            continue
        sig, own = J.signatures(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]), 3, 4)
        assert set(sig[own == 0]) & set(sig[own == 1]), (len(x), len(y), inter)


@pytest.mark.parametrize(("size", "other"), [(20, 24), (50, 60), (60, 70), (66, 70), (90, 100), (120, 140)])
def test_short_sets_find_each_other(size, other, monkeypatch):
    """With far too few segments for their need, both sets fall back on neighbourhoods or single shingles."""
    monkeypatch.setattr(J, "segments", lambda low, high, top, num, den: max(2, int(0.9 * J._most(low, top, num, den))))
    rng = np.random.default_rng(size)
    for _ in range(60):
        common = int(np.ceil(3 * (size + other) / 7))
        x = rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2)
        y = np.concatenate([x[:common], rng.integers(0, 1 << 63, other - common, dtype=np.uint64) * np.uint64(2)])
        x, y = np.unique(x), np.unique(y)
        sig, own = J.signatures(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]), 3, 4)
        assert set(sig[own == 0]) & set(sig[own == 1])


def test_maps_never_refuse_a_similar_pair():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 400))
        x = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        y = np.concatenate([x[: int(rng.integers(0, n + 1))], rng.integers(0, 1 << 63, int(rng.integers(0, 60)), dtype=np.uint64)])
        x, y = np.unique(x), np.unique(y)
        a, b = J._sketches(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]))
        inter = len(np.intersect1d(x, y))
        if inter and 4 * inter >= 3 * (len(x) + len(y) - inter):
            assert J._near(a, b, len(x) + len(y), 3, 4)


def test_shingle_counts_of_odd_texts():
    texts = ["", None, "a", "a b c d", "a b c d e", "A b\x0bc\x0cd\re f", "é b c d e f", "a b c d e a b c d e a", "x\x85y b c d e"]
    got = []
    for _, data, offsets in text_slices(pa.array(texts)):
        got += list(np.diff(shingle_sets(data, offsets)[1]))
    assert got == [len(shingles(t)) for t in texts]


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 50)] + [(7, 7), (None, 3)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(41)} | {100 + k: 100 for k in range(50)}


@pytest.mark.parametrize("share", [0.3, 0.5, 0.7, 0.85, 1.0, 1.3])
def test_no_similar_pair_is_left_to_chance(share, monkeypatch):
    """Elements crowded into few segments and few segments for the need: every similar pair meets all the same."""
    monkeypatch.setattr(J, "segments", lambda low, high, top, num, den: max(1, int(share * (J._most(low, top, num, den) + 1))))
    rng = np.random.default_rng(int(100 * share))
    met = 0
    for trial in range(600):
        size = int(rng.integers(1, 150))
        crowd = rng.integers(0, 1 << 64, 6, dtype=np.uint64) >> np.uint64(6) << np.uint64(6) if trial % 2 else None
        draw = lambda k: rng.integers(0, 1 << 64, k, dtype=np.uint64) if crowd is None else crowd[rng.integers(0, 6, k)] + rng.integers(0, 1 << 30, k, dtype=np.uint64)  # noqa: E731, B023
        x = np.unique(draw(size))
        gone = int(rng.integers(0, max(1, len(x) // 4) + 1))
        y = np.unique(np.concatenate([rng.permutation(x)[gone:], draw(int(rng.integers(0, max(1, len(x) // 4) + 1)))]))
        inter = len(np.intersect1d(x, y))
        if not inter or 4 * inter < 3 * (len(x) + len(y) - inter):
            continue
        met += 1
        sig, own = J.signatures(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]), 3, 4)
        assert set(sig[own == 0]) & set(sig[own == 1]), (trial, len(x), len(y), inter)
    assert met > 200


def test_deletions_are_allocated_to_as_many_segments_as_it_takes():
    """A set's emitted deletions make its worth reach its need, and no more segments have them than that takes."""
    rng = np.random.default_rng(8)
    for _ in range(200):
        n, m = int(rng.integers(2, 60)), int(rng.integers(2, 30))
        h = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        need = int(rng.integers(1, 2 * m))
        sig, _ = J._emit(h, np.zeros(len(h), int), np.array([len(h)]), np.array([m], np.uint64), np.array([need]), np.zeros(1, np.uint64))
        sizes = np.bincount(((h >> np.uint64(32)).astype(object) * m >> 32).astype(int), minlength=m)
        filled = int((sizes > 0).sum())
        doubles = [int(k) for k in sizes if k > 1]
        want = filled + sum(doubles[: max(0, need - filled)]) + (len(h) if need - filled > len(doubles) else 0)
        assert len(sig) == want


@pytest.mark.parametrize(("together", "block", "blocks"), [(3, 2, 64), (30, 5, 3), (200, 512, 64)])
def test_hot_signatures_against_brute_force(spark, words, together, block, blocks, monkeypatch):
    """A passage that most documents share, in components of many kinds: families are cut into blocks, or centres by signature."""
    for name, value in (("TOGETHER", together), ("BLOCK", block), ("BLOCKS", blocks)):
        monkeypatch.setattr(J, name, value)
    rng = random.Random(together)
    passage = [rng.choice(words) for _ in range(40)]
    rows = []
    for i in range(150):
        own = [rng.choice(words) for _ in range(rng.randint(0, 14))]
        w = passage[: rng.choice([40, 40, 34])] + own
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((i, " ".join(w)))
    got = sorted(map(tuple, J.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == brute(rows)


def test_a_family_s_pairs_are_told_once():
    """All pairs of different components, one of them at least outside the greatest, from all blocks together."""
    rng = np.random.default_rng(1)
    n, h = 60, rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    comp = np.where(np.arange(n) < 40, 7, rng.integers(100, 104, n))
    sketch = J._sketches(h, np.array([0, 40]))[0]
    told = []
    down, across = 3, 4
    for i in range(down):
        for j in range(across):
            family = J._Family(3, 4)
            rows = [(k, 1) for k in range(40, n) if k % down == i] + [(k, 0 if k < 40 else 2) for k in range(n) if k % across == j]
            for k in {k for k, _ in rows}:
                family.add(k, 40, sketch)
            if rows:
                ids = np.array([k for k, _ in rows])
                for x, y in family.pairs(ids, comp[ids], np.array([s for _, s in rows]), block=16):
                    told += [(min(p, q), max(p, q)) for p, q in zip(x.tolist(), y.tolist(), strict=True)]
    assert sorted(told) == [(x, y) for x in range(n) for y in range(x + 1, n) if comp[x] != comp[y]]

import re
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from chronogrid.llm import mixing as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sizes(rows):
    return [len(WORD.findall(t or "")) for _, t in rows]


def test_documents_and_sources(docs, corpus):
    got = M.mix(docs).taken().collect()
    assert sorted((r.doc_id, r["size"]) for r in got) == sorted((i, n) for (i, _), n in zip(corpus, sizes(corpus), strict=True))
    assert all(r.taken <= 2 * r["size"] for r in got)
    by = {}
    for r in got:
        s = by.setdefault([None, "s1", "s2", "s3"][r.doc_id % 4], [r.target, 0, 0, r.source_size])
        s[1] += r.taken
        s[2] += r["size"]
    assert all(abs(t - k) <= 2 * M.BLOCK and n == m for t, k, n, m in by.values())
    again = M.mix(docs.repartition(5)).taken().collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_texts_are_the_words_taken(docs):
    mixed = M.mix(docs)
    taken = {}
    for r in mixed.taken().collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    rows = mixed.texts(docs).collect()
    words = {}
    for r in rows:
        words[r.doc_id] = words.get(r.doc_id, 0) + len(WORD.findall(r.text))
        assert r.n_chars == len(r.text) and r.doc == "x" and r.key == "z"
    assert words == {i: n for i, n in taken.items() if n}
    whole = {r.doc_id: r.text for r in docs.collect()}
    assert all(set(r.text.split()) <= set(whole[r.doc_id].split()) for r in rows)


def test_empty_tables(spark, empty):
    assert M.mix(empty).taken().collect() == [] and M.mix(empty).texts(empty).collect() == []
    blank = spark.createDataFrame([(1, " ", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [r.taken for r in M.mix(blank).taken().collect()] == [0, 0]


def test_too_many_sources_are_refused(docs):
    with pytest.raises(ValueError):
        M.Mix(docs, most_sources=2)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.one_of(st.none(), st.text(max_size=3)), st.integers(0, 10_000), min_size=1, max_size=9))
def test_targets_share_out_everything(found):
    got = M.targets(found)
    assert sum(got.values()) == pytest.approx(1.5 * sum(found.values()))
    assert all(t <= 2 * found[s] + 1e-6 for s, t in got.items())
    order = sorted(found, key=lambda s: (s is None, s or ""))
    weight = {s: Fraction((3, 1, 2)[k % 3]) for k, s in enumerate(order)}
    free = [s for s in order if got[s] < 2 * found[s] - 1e-6]
    rates = [got[s] / float(weight[s]) for s in free]
    assert max(rates, default=0) == pytest.approx(min(rates, default=0))


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 65, 1000, 5000])
def test_permutation(n):
    p = M.permuted(np.arange(n), n, 12)
    assert sorted(p) == list(range(n))
    assert n < 60 or (p != M.permuted(np.arange(n), n, 13)).any()


def test_against_brute_force_word_by_word(docs, monkeypatch):
    """The sources' words laid out one by one, every slot's block cut from them, and each word's document counted."""
    monkeypatch.setattr(M, "SHARD_SLOTS", 3)
    monkeypatch.setattr(M, "GROUPS", 4)
    mixed = M.mix(docs)
    laid = {}
    for r in mixed.placed.orderBy("source_no", "start", "size").collect():
        words = laid.setdefault(r.source_no, [])
        assert r.start == len(words)
        words += [(r.doc_id, r.start)] * r["size"]
    wanted = {r.source_no: r.target for r in mixed.sources.collect()}
    taken, by_source, shards = {}, {}, {}
    for r in mixed.slots.collect():
        for key in laid[r.source_no][r.block * M.BLOCK : (r.block + 1) * M.BLOCK]:
            taken[key] = taken.get(key, 0) + 1
        by_source.setdefault(r.source_no, []).append((r.slot, r["pass"], r.block))
        shards[r.shard] = shards.get(r.shard, 0) + 1
    for source, slots in by_source.items():
        n = -(-len(laid[source]) // M.BLOCK)
        assert sorted(s for s, _, _ in slots) == list(range(len(slots)))
        assert len(slots) == min(2 * n, round(wanted[source] * n / len(laid[source])))
        for turn in {p for _, p, _ in slots}:
            met = [b for s, p, b in slots if p == turn]
            assert len(set(met)) == len(met) and set(met) <= set(range(n)) and all(s // n == turn for s, p, _ in slots if p == turn)
    assert sorted(shards) == list(range(len(shards))) and all(shards[k] == 3 for k in sorted(shards)[:-1])
    starts = {(r.doc_id, r.start): r["size"] for r in mixed.placed.where("size > 0").collect()}
    got = {}
    for r in mixed.rows().groupBy("doc_id", "start").agg({"words": "sum"}).collect():
        got[r.doc_id, r.start] = r["sum(words)"]
    assert got == taken and set(taken) <= set(starts)
    assert sorted(t for t in got.values()) == sorted(r.taken for r in mixed.taken().collect() if r.taken)


def test_draws_of_many_sources_stay_small_on_the_driver():
    slots = np.arange(10_000, dtype=np.int64) * 37
    groups = M._groups(slots, 5)
    assert len(groups) <= M.GROUPS
    assert (sum(np.frombuffer(g[3], np.int64) for g in groups) == slots).all()
    first, size, given, counts = groups[3]
    drawn, last = np.frombuffer(given, np.int64).copy(), {}
    for shard, source, start, n in M.shard_draws(first, size, given, counts, 5):
        assert start == drawn[source] and shard >= first
        drawn[source] += n
        last[shard] = last.get(shard, 0) + n
    assert set(last.values()) == {size} and (drawn == np.frombuffer(groups[4][2], np.int64)).all()

import itertools

import numpy as np
import pandas as pd
import pytest

from chronogrid.functions import kernels as K
from chronogrid.operators import tracks as T


def best_reward(times, pitches, other_times, other_pitches, tolerance, gap):
    """Greatest reward of all order-preserving matchings, by listing them."""
    n, m = len(times), len(other_times)
    best = -np.inf
    for size in range(min(n, m) + 1):
        for a in itertools.combinations(range(n), size):
            for b in itertools.combinations(range(m), size):
                apart = [abs(times[i] - other_times[j]) for i, j in zip(a, b, strict=True)]
                if all(pitches[i] == other_pitches[j] and d <= tolerance for i, j, d in zip(a, b, apart, strict=True)):
                    best = max(best, sum(1 - d / tolerance for d in apart) + gap * (n + m - 2 * size))
    return best


@pytest.mark.parametrize("seed", range(40))
def test_alignment_is_optimal_and_keeps_order(seed):
    rng = np.random.default_rng(seed)
    n, m = rng.integers(0, 7, 2)
    times, others = np.sort(rng.uniform(0, 6, n)), np.sort(rng.uniform(0, 6, m))
    p, q = rng.integers(0, 3, n), rng.integers(0, 3, m)
    found = K.align(times, p, others, q, 2.0, -0.3, 0.0)
    order = sorted(found.items())
    assert [j for _, j in order] == sorted(j for _, j in order)
    assert all(p[i] == q[j] and abs(times[i] - others[j]) <= 2 for i, j in order)
    reward = sum(1 - abs(times[i] - others[j]) / 2 for i, j in order) - 0.3 * (n + m - 2 * len(order))
    assert reward == pytest.approx(best_reward(times, p, others, q, 2.0, -0.3), abs=5e-3)


def test_rolled_chord_is_aligned_by_pitch():
    assert K.align([1.0, 1.02, 1.04], [64, 60, 67], [1.0, 1.0, 1.0], [60, 64, 67]) == {1: 0, 0: 1, 2: 2}
    assert K.align([], [], [1.0], [60]) == {}


@pytest.mark.parametrize(("times", "window", "want"), [([1.0, 1.02, 1.04], 0.05, [1, 1, 1]), ([1.0, 1.02, 1.2], 0.05, [1, 1, 1.2]), ([0, 0.04, 0.08, 0.12], 0.05, [0, 0, 0.08, 0.08]), ([0.3, 0.31], 0, [0.3, 0.31]), ([], 0.05, [])])
def test_group_starts(times, window, want):
    assert K.group_starts(np.array(times), window).tolist() == want


@pytest.mark.parametrize("seed", range(30))
def test_cheapest_matching_against_all(seed):
    rng = np.random.default_rng(seed)
    n, m = rng.integers(1, 6, 2)
    cost = rng.integers(0, 9, (n, m)).astype(float)
    pairs = K.cheapest_matching(cost)
    assert len({r for r, _ in pairs}) == len({c for _, c in pairs}) == len(pairs) == min(n, m)
    c = cost if n <= m else cost.T
    want = min(sum(c[i, p[i]] for i in range(len(c))) for p in itertools.permutations(range(c.shape[1]), len(c)))
    assert sum(cost[r, k] for r, k in pairs) == want


def test_strings():
    tuning = {0: 40, 1: 45, 2: 50}
    out = K.assign_strings([0, 0, 0.5, 2, 3], [1, 1, 1, 3, 4], [45, 45, 52, 30, 52], [-1, -1, -1, -1, 2], tuning)
    assert out.tolist() == [1, 0, 2, -1, 2]
    assert K.assign_strings([0, 0.1, 0.2, 0.3], [1, 1, 1, 1], [50, 50, 50, 50], [-1] * 4, tuning).tolist() == [2, 1, 0, 2]


def note(start=5, stop=12, n=20):
    onset, voiced, pitch = np.zeros(n, bool), np.zeros(n, bool), np.zeros(n)
    onset[start], voiced[start:stop], pitch[start:stop] = True, True, 110.0
    return onset, voiced, pitch


def test_move_note_start():
    onset, voiced, pitch = note()
    assert K.move_note_start(onset, voiced, pitch, 5, 3)
    assert np.flatnonzero(onset).tolist() == [3] and voiced[3:12].all() and (pitch[3:12] == 110).all()
    assert K.move_note_start(onset, voiced, pitch, 3, 7)
    assert np.flatnonzero(onset).tolist() == [7] and not voiced[3:7].any() and not pitch[3:7].any()
    assert not K.move_note_start(onset, voiced, pitch, 7, 12) and not K.move_note_start(onset, voiced, pitch, 7, 20)
    assert not K.move_note_start(onset, voiced, pitch, 6, 2)
    onset[2] = True
    assert not K.move_note_start(onset, voiced, pitch, 7, 1)
    onset, voiced, pitch = note()
    voiced[0:5], pitch[0:5] = True, 220.0
    assert K.move_note_start(onset, voiced, pitch, 5, 3) and pitch.tolist()[2:5] == [220, 110, 110]


def test_peaks_have_the_middle_of_a_level_top():
    assert K.peaks(np.array([0, 5, 0, 4, 4, 4, 1, 9]), 3).tolist() == [1, 4]
    assert K.peaks(np.array([0, 5, 5, 0, 2, 0]), 3).tolist() == [1] and K.peaks(np.array([9, 1]), 0).tolist() == []


RATE, HOP = 44_100, 256


def pluck(f0, seconds, rng):
    n, period = int(seconds * RATE), int(round(RATE / f0))
    x = np.zeros(n)
    x[:period] = rng.uniform(-1, 1, period)
    for k in range(period, n):
        x[k] = 0.498 * (x[k - period] + x[k - period - 1 if k > period else 0])
    return x


def scene(late_ms, count=26, seed=0):
    rng = np.random.default_rng(seed)
    tones = [146.8, 164.8, 196.0, 220.0, 246.9, 329.6]
    audio, truth, notes = rng.normal(0, 1e-4, int((count * 0.4 + 1) * RATE)), [], []
    plucks = {f: pluck(f, 0.35, rng) for f in tones}
    for k in range(count):
        at = int((0.3 + 0.4 * k) * RATE)
        f = tones[k % 6]
        audio[at : at + len(plucks[f])] += plucks[f]
        truth.append(at)
        notes.append(K.Note(k % 6, int((at + late_ms / 1000 * RATE) / HOP), f))
    return audio.astype(np.float32), truth, notes


@pytest.fixture(scope="module")
def late():
    return scene(17.0)


def test_prior_finds_how_late_labels_are(late):
    prior = K.estimate_prior(late[0], RATE, HOP, late[2])
    frame = HOP / RATE * 1000
    assert prior.anchors >= 20 and -17 - frame <= prior.shift_ms <= -16 + frame / 2
    assert K.estimate_prior(late[0], RATE, HOP, late[2][:15]) is None and K.estimate_prior(late[0], RATE, HOP, []) is None


def test_snaps_are_precise(late):
    audio, truth, notes = late
    snaps = K.snap_notes(audio, RATE, HOP, notes, K.estimate_prior(audio, RATE, HOP, notes))
    assert sum(s.status == "precise" for s in snaps) >= len(notes) - 2
    errors = [abs(s.sample - t) / RATE * 1000 for s, t in zip(snaps, truth, strict=True) if s.sample is not None]
    assert np.median(errors) < 2


def test_chords_are_kept_where_the_jitter_is_narrow(late):
    audio, _, notes = late
    chord = [K.Note(s, notes[0].frame, 110.0 * 2 ** (s / 6)) for s in range(6)]
    assert {s.status for s in K.snap_notes(audio, RATE, HOP, chord, K.Prior(0, 5, 0))} == {"kept"}


def test_grouped_operators(spark, late):
    audio, truth, notes = late
    size = HOP * 512
    chunks = spark.createDataFrame([("a", k // size, audio[k : k + size].tolist()) for k in range(0, len(audio), size)], "stem string, chunk long, samples array<float>")
    rows = spark.createDataFrame([("a", n.string, n.frame, n.f0) for n in notes], "stem string, string int, frame long, f0 double")
    priors = T.track_priors(chunks, rows, ["stem"], RATE, HOP)
    prior = priors.collect()[0]
    assert tuple(prior)[1:] == pytest.approx(tuple(K.estimate_prior(audio, RATE, HOP, notes)))
    got = T.snapped(chunks, rows, priors, ["stem"], RATE, HOP).collect()
    want = K.snap_notes(audio, RATE, HOP, notes, K.Prior(prior.shift_ms, prior.jitter_ms, 0))
    assert {(r.frame, r.string): (r.sample, r.status) for r in got} == {(n.frame, n.string): (s.sample, s.status) for n, s in zip(notes, want, strict=True)}

    a = spark.createDataFrame([("a", 0, 1.0, 60), ("a", 1, 2.0, 62), ("b", 0, 1.0, 60)], "stem string, idx long, time double, pitch int")
    b = spark.createDataFrame([("a", 0, 1.1, 60), ("a", 1, 1.9, 62)], "stem string, idx long, time double, pitch int")
    assert sorted(map(tuple, T.monotone_align(a, b, ["stem"]).collect())) == [("a", 0, 0), ("a", 1, 1)]
    onset, voiced, pitch = note()
    frames = spark.createDataFrame(pd.DataFrame({"stem": "a", "frame": range(20), "pitch": pitch, "voiced": voiced, "onset": onset}))
    moves = spark.createDataFrame([("a", 5, 3)], "stem string, frame long, target long")
    moved = T.move_starts(frames, moves, ["stem"]).orderBy("frame").collect()
    assert [r.frame for r in moved if r.onset] == [3] and moved[0].moved == 1


def test_strings_against_every_note_that_was_held():
    """The definition, with each note held against all notes that its string ever held."""
    rng = np.random.default_rng(5)
    tuning = dict(enumerate((40, 45, 50, 55, 59, 64)))
    for _ in range(300):
        n = int(rng.integers(0, 40))
        onset = np.round(rng.uniform(0, 5, n), 1)
        offset = onset + np.round(rng.uniform(-0.2, 2, n), 1)
        pitch, given = rng.integers(30, 95, n), np.where(rng.random(n) < 0.3, rng.integers(0, 7, n), -1)
        want, held = given.copy(), {}
        for k in np.flatnonzero(given >= 0):
            held.setdefault(int(given[k]), []).append(k)
        for k in np.argsort(onset, kind="stable"):
            frets = sorted((pitch[k] - o, s) for s, o in tuning.items() if 0 <= pitch[k] - o <= K.MOST_FRET)
            free = [s for _, s in frets if all(onset[k] >= offset[h] or onset[h] >= offset[k] for h in held.get(s, []))]
            if given[k] < 0 and frets:
                want[k] = free[0] if free else frets[0][1]
                held.setdefault(int(want[k]), []).append(k)
        assert K.assign_strings(onset, offset, pitch, given, tuning).tolist() == want.tolist()


def test_long_alignment_in_little_memory():
    import tracemalloc

    rng = np.random.default_rng(6)
    n = 6000
    t, p = np.sort(rng.uniform(0, 3000, n)), rng.integers(40, 80, n)
    tracemalloc.start()
    found = K.align(t, p, t + rng.normal(0, 0.01, n), p)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < n * n // 2 and sum(i == j for i, j in found.items()) > 0.8 * n  # a byte a cell would be n * n


def test_groups_of_a_long_list():
    t = np.sort(np.random.default_rng(2).uniform(0, 1000, 20_000))
    want, anchor = [], None
    for x in t:
        anchor = x if anchor is None or x - anchor > 0.3 else anchor
        want.append(anchor)
    assert K.group_starts(t, 0.3).tolist() == want

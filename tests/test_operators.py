"""Operators on the literal cases that define them."""

import math
import random

import pytest
from pyspark.sql import functions as F

from chronogrid.functions import scalars as X
from chronogrid.operators import aggregates as A, grid as G, joins as J, notes as N, sequences as S, splits as P


def contour(spark, pitches):
    return spark.createDataFrame([("n", k, float(p)) for k, p in enumerate(pitches)], "note string, frame long, pitch double")


HOP_MS = 64 / 11_025 * 1000
LEVEL = [110.0] * 40


def slide(a, b, n):
    return [a + (b - a) * k / (n - 1) for k in range(n)]


@pytest.mark.parametrize(
    ("pitches", "action", "last"),
    [
        (LEVEL + slide(105, 97, 5), "flattened", 110.0),
        (LEVEL + slide(108, 98, 10) + [98.0] * 10, "preserved", 98.0),
        (LEVEL + slide(108, 80, 20), "ambiguous-flattened", 110.0),
        (LEVEL + slide(105, 98, 6) + [98.0] * 7, "ambiguous-flattened", 110.0),
        (LEVEL + slide(113, 125, 5), "none", 125.0),
        (LEVEL, "none", 110.0),
        ([0.0, 0.0], "none", 0.0),
    ],
)
def test_tails(spark, pitches, action, last):
    frames = contour(spark, pitches)
    notes = N.tails(frames, ["note"], "frame", "pitch", HOP_MS)
    assert notes.collect()[0].action == action
    assert N.flatten(frames, ["note"], "frame", "pitch", HOP_MS).orderBy(F.desc("frame")).first().pitch == pytest.approx(last)


@pytest.mark.parametrize(("tail", "silent"), [(2 ** (120 / 1200), 4), (2 ** (5 / 1200), 0), (2 ** (200 / 1200), 4)])
def test_overhangs(spark, tail, silent):
    out = N.overhangs(contour(spark, [220.0] * 20 + [220 * tail] * 4), ["note"], "frame", "pitch")
    assert out.where("silent").count() == silent
    assert N.overhangs(contour(spark, [220.0, 300.0]), ["note"], "frame", "pitch").where("silent").count() == 0


@pytest.mark.parametrize(("times", "gap", "want"), [([1.0, 1.02, 1.04], 0.05, [1, 1, 1]), ([1.0, 1.02, 1.2], 0.05, [1, 1, 1.2]), ([0.0, 0.04, 0.08, 0.12], 0.05, [0, 0, 0.08, 0.08]), ([0.5, 0.51], 0, [0.5, 0.51])])
def test_anchored_groups(spark, times, gap, want):
    df = spark.createDataFrame([("a", k, t) for k, t in enumerate(times)] + [(None, 0, 7.0)], "k string, i long, t double")
    got = S.anchored_groups(df, ["k"], ["t", "i"], "t", gap).where("k = 'a'").orderBy("i").collect()
    assert [r.anchor for r in got] == want


def test_tempo_map(spark):
    q = 960
    changes = spark.createDataFrame([("a", 0, 120), ("a", 2 * q, 240), ("b", 0, 120), ("b", q, 240), ("b", 2 * q, 60)], "k string, tick long, bpm long")
    events = spark.createDataFrame([(k, t * q) for k in "ab" for t in range(5)], "k string, tick long")
    got = S.ticks_to_seconds(events, S.tempo_sections(changes, ["k"], "tick", "bpm", q), ["k"], "tick").orderBy("k", "tick").collect()
    assert [r.seconds for r in got] == pytest.approx([0, 0.5, 1, 1.25, 1.5, 0, 0.5, 0.75, 1.75, 2.75])
    late = spark.createDataFrame([("c", q, 60)], "k string, tick long, bpm long")
    got = S.ticks_to_seconds(spark.createDataFrame([("c", 2 * q)], "k string, tick long"), S.tempo_sections(late, ["k"], "tick", "bpm", q), ["k"], "tick")
    assert got.first().seconds == pytest.approx(1.5)


def test_rasterise_keeps_overwritten_onsets(spark):
    notes = spark.createDataFrame([("a", 0, 0.0, 5.0, 60), ("a", 1, 2.0, 3.0, 62), ("a", 2, 9.4, 9.4, 64), ("a", 3, 12.0, 40.0, 65), ("a", 4, -3.0, -2.0, 66), ("a", 5, 2.5, 2.6, 67)], "k string, idx long, on double, off double, pitch int")
    late = G.note_frames(notes, "on", "off", 1.0, 14)
    rows = {r.frame: (r.pitch, r.onset) for r in G.rasterise(late, ["k"], ["idx"], "pitch").collect()}
    assert rows == {0: (60, True), 1: (60, False), 2: (67, True), 3: (60, False), 4: (60, False), 9: (64, True), 12: (65, True), 13: (65, False)}
    early = G.rasterise(G.note_frames(notes, "on", "off", 1.0, 14, "early"), ["k"], ["idx"], "pitch")
    assert early.where("frame = 0").first().pitch == 66


def test_resample_snaps_short_sequences(spark):
    points = spark.createDataFrame([("a", 0, 0.0, 100.0), ("a", 1, 2.0, 400.0), ("b", 0, 3.3, 50.0), ("c", 0, 1.0, 7.0)], "k string, i long, t double, hz double")
    rows = {(r.k, r.frame): r.hz for r in G.resample(points, ["k"], ["t", "i"], "t", "hz", 1.0).collect()}
    assert rows == pytest.approx({("a", 0): 100, ("a", 1): 200, ("a", 2): 400, ("b", 3): 50, ("c", 1): 7})


def test_logarithms_of_zero_and_below(spark):
    rows = spark.createDataFrame([(0.0,), (-1.0,), (None,), (880.0,)], "x double")
    got = [tuple(r) for r in rows.select(X.log2("x"), X.hz_to_midi("x"), X.cents("x", F.lit(440.0)), X.decibels("x"), X.sounding_cents("x", F.lit(440.0))).collect()]
    assert got[0] == (-math.inf, -math.inf, -math.inf, pytest.approx(-120), None)
    assert all(map(math.isnan, got[1][:4])) and got[1][4] is None
    assert got[2] == (None,) * 5
    assert got[3] == pytest.approx((math.log2(880), 81, 1200, 10 * math.log10(880), 1200))
    assert rows.select(X.cents("x", F.lit(0.0)).alias("c")).where("c IS NOT NULL").count() == 0


def test_resample_of_a_value_of_zero(spark):
    # The logarithm of 0 is -inf: a line to it is 0 right after its start, where it is no number.
    points = spark.createDataFrame([("a", 0, 0.0, 4.0), ("a", 1, 2.0, 0.0), ("b", 0, 3.3, 0.0)], "k string, i long, t double, hz double")
    rows = {(r.k, r.frame): r.hz for r in G.resample(points, ["k"], ["t", "i"], "t", "hz", 1.0).collect()}
    assert math.isnan(rows.pop(("a", 0)))
    assert rows == {("a", 1): 0.0, ("a", 2): 0.0, ("b", 3): 0.0}


def test_interpolation_is_kept_at_the_ends(spark):
    anchors = spark.createDataFrame([("a", 1.0, 10.0, 0), ("a", 1.0, 99.0, 1), ("a", 3.0, 20.0, 2)], "k string, x double, y double, i int")
    events = spark.createDataFrame([("a", v) for v in (0.0, 1.0, 2.0, 3.0, 9.0)] + [("b", 1.0)], "k string, at double")
    got = G.interpolate(events, anchors.withColumnRenamed("y", "ay"), ["k"], "at", "x", "ay", ["i"]).orderBy("k", "at").collect()
    assert [r.y for r in got] == [10, 10, 15, 20, 20, None]


def test_windows_and_tiles(spark):
    tracks = spark.createDataFrame([("a", 172), ("b", 344), ("c", 86), ("d", 0)], "stem string, n long")
    starts = [r.start for r in G.tiles(tracks, "n", 8).orderBy("stem", "start").collect()]
    assert len(starts) == 22 + 43 + 11 and starts[:3] == [0, 8, 16]
    df = spark.createDataFrame([([1, 2, 3], 2)], "a array<int>, s long")
    assert df.select(G.padded("a", "s", 4, 0).alias("w")).first().w == [3, 0, 0, 0]


def test_translation(spark):
    frames = spark.createDataFrame([("a", f, True, f == 5) for f in range(5, 12)], "k string, frame long, voiced boolean, onset boolean")
    moved = {r.frame: r.onset for r in G.translate(frames, ["k"], -3, 20).collect()}
    assert sorted(moved) == list(range(2, 9)) and moved[2]
    cut = {r.frame: r.onset for r in G.translate(frames, ["k"], -7, 20).collect()}
    assert sorted(cut) == list(range(5)) and cut == {0: True, 1: False, 2: False, 3: False, 4: False}
    assert G.translate(frames, ["k"], 12, 20).count() == 3


@pytest.mark.parametrize(("score", "played", "want"), [([60, 62, 64], [60, 62, 64], 0), ([48, 50, 52], [60, 62, 64], 12), ([47, 47], [60, 60], 0), ([], [60], 0), ([40] * 64 + [52], [52] * 64 + [40], 12)])
def test_best_shift(spark, score, played, want):
    a = spark.createDataFrame([("x", p) for p in score], "k string, pitch int")
    b = spark.createDataFrame([("x", p) for p in played], "k string, pitch int")
    assert J.best_shift(a, b, ["k"], "pitch", 12).collect()[0]["shift"] == want


def test_splits(spark):
    stems = spark.createDataFrame([(f"{p:02d}_track_{k:02d}", p) for p in range(6) for k in range(10)], "stem string, player int")
    player = F.substring("stem", 1, 2)
    counts = {r.split: r["count"] for r in P.by_group(stems, player, ["04"], ["05"]).groupBy("split").count().collect()}
    assert counts == {"train": 40, "valid": 10, "test": 10}
    folds = P.folds(stems, F.col("player"), 6)
    tests = folds.where("split = 'test'").select("fold", "player").distinct().collect()
    assert sorted((r.fold, r.player) for r in tests) == [(k, k) for k in range(6)]
    assert folds.groupBy("fold", "stem").count().where("count > 1").count() == 0
    once, again = (sorted(map(tuple, P.random_split(stems, "stem", 42).select("stem", "split").collect())) for _ in range(2))
    assert once == again and sum(s == "test" for _, s in once) == 9
    assert P.numpy_permutation(["b", "a", "c"], 1) == P.numpy_permutation(["c", "b", "a"], 1)
    both = P.held_out(stems, player, "03").where("stem LIKE '03%'").select("split").distinct().collect()
    assert {r.split for r in both} == {"valid", "test"}


def test_priors_need_anchors(spark):
    df = spark.createDataFrame([("a", float(k % 5)) for k in range(20)] + [("b", 1.0)] * 19, "k string, ms double")
    rows = A.robust_prior(df, ["k"], "ms").collect()
    assert [(r.k, r["shift"], r.jitter, r.anchors) for r in rows] == [("a", 2.0, 4.0, 20)]


@pytest.mark.parametrize(("midi", "name"), [(64, "E4"), (40, "E2"), (69, "A4"), (0, "C-1"), (61.4, "C#4")])
def test_note_names(spark, midi, name):
    assert spark.range(1).select(X.note_name(F.lit(midi))).first()[0] == name


def test_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([("a", 1, None, None), ("a", 2, 5.0, "x"), (None, 1, None, "x")], "k string, i long, t double, v string")
    assert S.segments(df, ["k"], ["i"], "t", "v", 1.0).count() == 3
    assert S.change_onsets(df, ["k"], ["i"], "v").where("onset").count() == 2
    none = df.limit(0)
    for out in (S.gap_clusters(none, ["k"], ["i"], "t", 1.0), S.anchored_groups(none, ["k"], ["i"], "t", 1.0), S.trailing_run(none, ["k"], ["i"], F.col("t") > 1), A.mode_first_seen(none, ["k"], "v", ["i"])):
        assert out.collect() == []


def test_anchored_groups_of_many_keys_and_falling_times(spark):
    rng = random.Random(4)
    rows = [(k % 7 if k % 11 else None, k, float(rng.randrange(200)) / 10) for k in range(600)]
    df = spark.createDataFrame(rows, "g int, idx long, time double").repartition(3)
    for order in (["time", "idx"], ["idx"]):
        got = {r.idx: r.anchor for r in S.anchored_groups(df, ["g"], order, "time", 0.45).collect()}
        want = {}
        for g in {r[0] for r in rows}:
            anchor = None
            for _, idx, time in sorted((r for r in rows if r[0] == g), key=lambda r: (r[2], r[1]) if order[0] == "time" else r[1]):
                anchor = time if anchor is None or time - anchor > 0.45 else anchor
                want[idx] = anchor
        assert got == want


def test_positions_in_tracks_that_reach_over_many_cells(spark):
    tracks = [("a", 0, 10), ("b", 10, 0), ("c", 10, 300), ("d", 310, 1), ("e", 311, 64)]
    asked = [(k, p) for k, p in enumerate([-1, 0, 9, 10, 309, 310, 311, 374, 375, 9, 64, 128, 10**12])]
    index = spark.createDataFrame(asked, "k long, position long")
    t = spark.createDataFrame(tracks, "stem string, from long, n long")
    for cell in (1, 16, 64, 1 << 16):
        got = sorted((r.k, r.stem, r.frame) for r in G.item_of(index, t, "position", "from", "n", ["stem"], cell).collect())
        assert got == sorted((k, s, p - a) for k, p in asked for s, a, n in tracks if a <= p < a + n)


def test_offsets_in_two_levels(spark):
    rows = [(k, (k * 37) % 11, "x" if k % 2 else None) for k in range(200)]
    df = spark.createDataFrame(rows, "k long, size long, g string").repartition(4)
    for keys in ([], ["g"]):
        one = sorted(map(tuple, S.offsets(df, ["k"], "size", keys).select("k", "offset").collect()))
        two = sorted(map(tuple, S.offsets(df, ["k"], "size", keys, bucket=F.floor(F.col("k") / 16)).select("k", "offset").collect()))
        assert one == two and len(one) == 200


def test_unknown_group_of_folds_ends_the_job(spark):
    df = spark.createDataFrame([(0,), (7,), (None,)], "g int")
    assert P.folds(df.where("g = 0"), F.col("g"), 6).count() == 6
    for bad in ("g = 7", "g IS NULL"):
        with pytest.raises(Exception, match="unknown group"):
            P.folds(df.where(bad), F.col("g"), 6).collect()


def test_lenient_int_of_columns_and_expressions(spark):
    df = spark.createDataFrame([("42",), (" 7.9",), ("x",), (None,)], "a string")
    for c in ("a", F.col("a")):
        assert [r[0] for r in df.select(X.lenient_int(c)).collect()] == [42, 7, 0, 0]

import json

import numpy as np
import pytest

from chronogrid.plans import recipes as R
from tests.test_kernels import HOP, RATE, scene
from tests.test_sources import SCORE, as_files, measure, smf, song

GRID = 0.01


def notes_midi(notes):
    """A MIDI file, 480 ticks a second, of (start, end, pitch)."""
    events = sorted([(s, 1, p) for s, _, p in notes] + [(e, 0, p) for _, e, p in notes])
    out, last = [(0, b"\xff\x51\x03" + (1_000_000).to_bytes(3, "big"))], 0
    for t, on, p in events:
        tick = round(t * 480)
        out.append((tick - last, bytes([0x90 if on else 0x80, p, 80])))
        last = tick
    return smf([[out[0]], out[1:]])


def lengths(spark, *stems, n=400):
    return spark.createDataFrame([(s, n) for s in stems], "stem string, n_frames long")


def test_contours(spark):
    obs = [{"time": k * 256 / 44_100, "duration": 0, "confidence": 1, "value": {"voiced": True, "frequency": 110.0 if k < 30 else 220.0, "index": int(k >= 30)}} for k in range(60)]
    jam = json.dumps({"annotations": [{"namespace": "pitch_contour", "data": obs}]}).encode()
    rows = R.contour_frames(as_files(spark, a=jam), lengths(spark, "a"), GRID).orderBy("frame").collect()
    assert [r.frame for r in rows] == list(range(len(rows))) and 34 <= len(rows) <= 36
    assert sum(r.onset for r in rows) == 2 and {round(r.pitch, 3) for r in rows} == {110.0, 220.0}


def test_synced_scores_leave_a_report(spark):
    # Two bars of 6 divisions, played twice: bar k begins at second k.
    played = notes_midi([(0.0, 0.3, 64), (0.02, 0.3, 60), (0.68, 0.9, 55), (1.34, 1.6, 65), (2.0, 2.4, 64), (3.3, 3.5, 99)])
    sync = b"[[0, 0.0], [1, 1.0], [2, 2.0], [3, 3.0]]"
    frames, report = R.synced_score_frames(as_files(spark, a=played, b=b"bad", d=played, e=played), as_files(spark, a=SCORE, b=SCORE, c=SCORE, d=SCORE, e=SCORE), as_files(spark, a=sync, b=sync, c=sync, d=b"[[0, 0], [9, 5]]", e=b"[]"), lengths(spark, "a", "b", "c", "d", "e"), GRID)
    got = {r.stem: r.reason for r in report.collect()}
    assert got["a"] is None and got["c"] == "missing midi" and got["d"] == "measures disagree" and got["e"] == "fewer than two sync points" and "MIDI" in got["b"]
    rows = frames.collect()
    assert {r.stem for r in rows} == {"a"}
    onsets = sorted((r.frame, r.string, round(12 * np.log2(r.pitch / 440) + 69)) for r in rows if r.onset)
    assert onsets[0] == (0, 5, 64) and (2, 4, 60) in onsets and (200, 5, 64) in onsets


def test_tablature(spark):
    tab = song(measure(1, [(1, 0, "normal"), (1, 2, "normal"), (6, 3, "normal")]), capo=0)
    played = notes_midi([(0.0, 0.4, 76), (0.5, 0.9, 78), (1.0, 1.4, 55)])
    frames, report = R.tablature_frames(as_files(spark, a=played, b=b"x"), as_files(spark, a=tab, b=tab), lengths(spark, "a", "b"), GRID)
    got = {r.stem: (r.reason is None, r["shift"]) for r in report.collect()}
    assert got["a"] == (True, 12) and not got["b"][0]
    assert sorted((r.frame, r.string) for r in frames.where("onset").collect()) == [(0, 5), (50, 5), (100, 0)]


def test_string_midi(spark):
    data = smf([[(0, b"\xff\x51\x03" + (1_000_000).to_bytes(3, "big"))], [(480, b"\x90\x40\x50"), (240, b"\x80\x40\0"), (5, b"\x90\x41\x50"), (240, b"\x80\x41\0")]])
    rows = R.string_midi_frames(as_files(spark, a=data), lengths(spark, "a"), GRID, latency_ms=0.0).orderBy("frame").collect()
    assert [r.frame for r in rows if r.onset] == [100] and rows[-1].frame == 200 and {r.string for r in rows} == {5}


@pytest.mark.parametrize(("fine", "coarse", "score", "unaligned", "notes", "reason"), [("f", "c", "0.7", True, "f", None), ("f", "c", " ", True, "f", None), ("f", "c", "0.2", True, None, "alignment score too low"), (None, "c", None, True, "c", None), (None, "c", None, False, None, "no notes"), (None, None, None, True, None, "no notes")])
def test_gate(spark, fine, coarse, score, unaligned, notes, reason):
    r = R.gated(spark.createDataFrame([(fine, coarse, score)], "fine string, coarse string, score string"), unaligned=unaligned).first()
    assert (r.notes, r.reason) == (notes, reason)


@pytest.fixture(scope="module")
def tracks(spark):
    sizes = {"track_a": 172, "track_b": 344, "track_c": 86}
    frames = [(s, k, f, 110.0, True, f == 0) for s, n in sizes.items() for k in range(6) for f in range(n // 2)]
    return spark.createDataFrame(frames, "stem string, string int, frame long, pitch double, voiced boolean, onset boolean"), spark.createDataFrame(list(sizes.items()), "stem string, n_frames long")


def test_items(spark, tracks):
    frames, sizes = tracks
    split = spark.createDataFrame([("track_a",), ("track_b",)], "stem string")
    train = R.items(frames, sizes, split, 8, batch=4).collect()
    assert sorted((r.stem, r.start) for r in train) == sorted([("track_a", f) for f in range(86)] + [("track_b", f) for f in range(172)])
    assert sorted(r.place for r in train) == list(range(258)) and all(r.batch == r.place // 4 for r in train)
    assert train != R.items(frames, sizes, split, 8, epoch=1).collect()
    assert sorted((r.stem, r.start) for r in R.items(frames, sizes, split, 8, onsets=True).collect()) == [("track_a", 0), ("track_b", 0)]
    tiles = sorted(R.items(frames, sizes, split, 8, train=False).collect(), key=lambda r: r.place)
    assert [(r.stem, r.start) for r in tiles] == [("track_a", f) for f in range(0, 172, 8)] + [("track_b", f) for f in range(0, 344, 8)]
    assert R.items(frames, sizes, split, 200, train=False).select("stem").distinct().count() == 1


def test_served_windows_end_with_the_grid(spark):
    packed = spark.createDataFrame([("a", 5, [1.0] * (5 * 4 + 3), [[9.0] * 5], [[True] * 5], [[False] * 5])], "stem string, n_frames long, audio array<float>, pitch array<array<float>>, voiced array<array<boolean>>, onset array<array<boolean>>")
    r = R.served(spark.createDataFrame([("a", 3, 0, 0)], "stem string, start long, place long, batch long"), packed, 4, 4).first()
    assert sum(r.audio) == 8 and len(r.audio) == 16 and r.pitch == [[9, 9, 0, 0]] and r.voiced == [[True, True, False, False]]


def test_corrected_labels(spark):
    audio, truth, notes = scene(17.0)
    size = HOP * 2048
    chunks = spark.createDataFrame([("a", k // size, audio[k : k + size].tolist()) for k in range(0, len(audio), size)], "stem string, chunk long, samples array<float>")
    n = len(audio) // HOP
    frames = spark.createDataFrame([("a", x.string, f, x.f0, True, f == x.frame) for x in notes for f in range(x.frame, x.frame + 40)], "stem string, string int, frame long, pitch double, voiced boolean, onset boolean")
    grid = spark.createDataFrame([("a", n)], "stem string, n_frames long")
    right = {t // HOP for t in truth}
    exact = {}
    for mode in ("constant", "per-track", "snap"):
        got = R.corrected(chunks, frames, grid, RATE, HOP, mode, -3).where("onset").collect()
        assert len(got) == len(notes)
        exact[mode] = sum(r.frame in right for r in got)
    assert exact["snap"] >= 0.8 * len(notes) and exact["snap"] >= exact["per-track"]
    with pytest.raises(ValueError):
        R.corrected(chunks, frames, grid, RATE, HOP, "other")

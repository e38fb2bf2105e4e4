import io
import json
import struct
import wave

import numpy as np
import pytest

from chronogrid.sources import files as S, midi as M, scores as X, tables as B


def as_files(spark, **content):
    return spark.createDataFrame([(f"/x/{k}.bin", k, bytearray(v)) for k, v in content.items()], "path string, stem string, content binary")


def number(n):
    out = [n & 0x7F]
    while n := n >> 7:
        out.append(n & 0x7F | 0x80)
    return bytes(out[::-1])


def smf(tracks, division=480):
    out = b"MThd" + struct.pack(">IHHH", 6, 1, len(tracks), division)
    for events in tracks:
        body = b"".join(number(delta) + raw for delta, raw in events) + b"\0\xff\x2f\0"
        out += b"MTrk" + struct.pack(">I", len(body)) + body
    return out


TEMPO = b"\xff\x51\x03" + (1_000_000).to_bytes(3, "big")


def test_merged_midi_ends_the_first_of_a_pitch():
    data = smf([[(0, TEMPO), (480, b"\xff\x51\x03" + (500_000).to_bytes(3, "big"))], [(0, b"\x90\x40\x50"), (240, b"\x40\x50"), (240, b"\x40\0"), (480, b"\x80\x40\x10"), (0, b"\x80\x41\0"), (0, b"\xc0\x05"), (0, b"\xf0\x02ab"), (0, b"\x90\x30\x7f")]])
    assert M.merged_notes(data) == [(0, 0.0, 1.0, 64), (1, 0.5, 1.5, 64)]


def test_string_tracks_end_the_latest_and_lose_latency():
    data = smf([[(0, TEMPO)], [(0, b"\x90\x40\x50"), (240, b"\x90\x40\x50"), (240, b"\x80\x40\0"), (0, b"\x80\x40\0")], [(0, b"\x90\x30\x50"), (4, b"\x80\x30\0")]])
    assert M.string_notes(data) == [(0, 5, 64, pytest.approx(0.477), pytest.approx(0.977))]
    assert [n[1] for n in M.string_notes(data, 0.0)] == [4, 5]


def test_bad_files_are_rows_with_a_reason(spark):
    rows = M.read_merged(as_files(spark, good=smf([[(0, b"\x90\x40\x50"), (480, b"\x80\x40\0")]]), bad=b"no", cut=smf([[(0, b"\x90\x40\x50")]])[:-6])).collect()
    assert {r.stem: (r.reason is None, r.pitch) for r in rows} == {"good": (True, 64), "bad": (False, None), "cut": (False, None)}


def bars(*specs):
    return [{"forward": "f" in s, "times": int(s[s.index("b") + 1]) if "b" in s else None, "endings": {int(c) for c in s.split("e")[1][:1]} if "e" in s else set(), "stop": "s" in s} for s in specs]


@pytest.mark.parametrize(("written", "played"), [(("", "", ""), [0, 1, 2]), (("", "b2", ""), [0, 1, 0, 1, 2]), (("f", "b2"), [0, 1, 0, 1]), (("f", "e1sb2", "e2s"), [0, 1, 0, 2]), (("", "b3"), [0, 1, 0, 1, 0, 1]), (("", "b2", "f", "b2"), [0, 1, 0, 1, 2, 3, 2, 3]), (("b2", "", "", ""), [0, 0, 1, 2, 3]), ((), [])])
def test_repeats(written, played):
    assert X.performed(bars(*written)) == played


def test_a_runaway_order_is_the_written_one():
    assert X.performed([{"forward": False, "times": 500, "endings": set(), "stop": False}]) == [0]


def xml_note(step="E", octave=4, string=1, fret=0, duration=2, more=""):
    return f"<note>{more}<pitch><step>{step}</step><octave>{octave}</octave></pitch><duration>{duration}</duration><notations><technical><string>{string}</string><fret>{fret}</fret></technical></notations></note>"


SCORE = f"""<score-partwise><part id="a"><measure><note><rest/></note></measure></part><part id="b">
<measure><attributes><divisions>2</divisions><time><beats>3</beats><beat-type>4</beat-type></time><staff-details><staff-tuning line="1"><tuning-step>D</tuning-step><tuning-octave>2</tuning-octave></staff-tuning><staff-tuning line="6"><tuning-step>E</tuning-step><tuning-octave>4</tuning-octave></staff-tuning><staff-tuning line="2"><tuning-step>A</tuning-step></staff-tuning></staff-details></attributes>
{xml_note()}{xml_note("C", 4, 2, 1, 2, "<chord/>")}<note><rest/><duration>2</duration></note>{xml_note("G", 3, 3, 0, 0, "<grace/>")}{xml_note("A", 3, 3, 2)}<backup><duration>6</duration></backup><forward><duration>1</duration></forward>{xml_note("B", 3, 2, 0)}</measure>
<measure>{xml_note(" ", 4)}{xml_note("F", 4, 1, 1)}<barline location="right"><repeat direction="backward"/></barline></measure></part></score-partwise>""".encode()


def test_musicxml(spark):
    first = [(0, 0, 6, 64, 1, 0), (0, 0, 6, 60, 2, 1), (0, 4, 6, 55, 3, 0), (0, 4, 6, 57, 3, 2), (0, 1, 6, 59, 2, 0), (1, 2, 6, 65, 1, 1)]
    want = first + [(m + 2, *rest) for m, *rest in first]
    assert [r[1:] for r in X.musicxml_notes(SCORE)] == want
    assert X.musicxml_tuning(SCORE) == [(1, 64), (6, 38)] and X.musicxml_measures(SCORE) == [(2, 4)]
    assert [tuple(r)[2:] for r in X.read_measure_counts(as_files(spark, a=SCORE)).collect()] == [(2, 4)]
    assert X.read_musicxml(as_files(spark, a=SCORE, b=b"<x", c=b"<score-partwise/>")).where("reason IS NOT NULL").count() == 2


@pytest.mark.parametrize(("args", "want"), [(("C", "4", None), 60), (("f", "-1", "1"), 6), (("H", "4", None), None), (("C", "x", None), None), (("E", "4", "-1.0"), 63), (("E", "4", "?"), 64)])
def test_pitches(args, want):
    assert X.pitch_of(*args) == want


def song(*measures, **more):
    return json.dumps({"tempo": 120, "tuning": {"1": 64, "6": 40}, "capo": 2, "measures": list(measures)} | more).encode()


def measure(n, notes=(), **more):
    return {"number": n, "length": 3840, "beats": [{"tick": k * 960, "notes": [{"string": s, "fret": f, "type": t}]} for k, (s, f, t) in enumerate(notes)]} | more


def test_tablature(spark):
    data = song(measure(1, [(1, 0, "normal"), (1, 0, "tie"), (6, 3, "dead"), (9, 0, "normal")]), measure(2, [(6, 0, "normal")], close=2))
    got = X.tablature(data)
    assert got["tuning"] == {1: 66, 6: 42}
    assert [(n[0], n[4]) for n in got["notes"]] == [(t, p) for k in range(3) for t, p in ((k * 7680, 66), (k * 7680 + 1920, 45), (k * 7680 + 3840, 42))]
    rows = X.read_tablature(as_files(spark, a=data, b=song(measure(1, alternative=1)))).collect()
    assert sum(r.stem == "a" for r in rows) == 9 and "alternate ending" in [r.reason for r in rows if r.stem == "b"][0]


@pytest.mark.parametrize(("closes", "played"), [({1: 2}, [0, 1, 0, 1, 0, 1, 2]), ({}, [0, 1, 2])])
def test_tablature_repeats(closes, played):
    assert X.repeated([{"close": closes.get(k, 0)} for k in range(3)]) == played
    assert X.repeated([{}, {"open": True}, {"close": 1}, {}]) == [0, 1, 2, 1, 2, 3]


def test_jams(spark):
    obs = lambda t, f, v, **k: {"time": t, "duration": 0.0, "confidence": None, "value": {"voiced": v, "frequency": f, **k}}
    jam = {"annotations": [{"namespace": "tempo", "data": []}, {"namespace": "pitch_contour", "data": [obs(0.0, 82.4, True), obs(0.1, 0.0, True), obs(0.2, 82.0, False), obs(0.3, 83.0, True, index=2)]}, {"namespace": "pitch_contour", "data": [obs(0.0, 110.0, True, index=1)]}]}
    rows = B.jams_observations(as_files(spark, a=json.dumps(jam).encode())).collect()
    assert sorted((r.string, r.idx, r.frequency, r.note_id) for r in rows) == [(0, 0, 82.4, 0), (0, 3, 83.0, 2), (1, 0, 110.0, 1)]


def test_catalogues(spark, tmp_path):
    rows = B.sync_points(as_files(spark, a=b"[[1, 0.5], [2], [3, 1.5, 2]]")).orderBy("idx").collect()
    assert [(r.measure, r.seconds, r.offset) for r in rows] == [(1, 0.5, None), (3, 1.5, 2)]
    (tmp_path / "m.csv").write_text("id,split,other\na,train,1\nb, ,2\nc,,3\nd,test,4\n")
    got = B.metadata(spark, str(tmp_path / "m.csv"), ["id", "split", "performer"], "split").collect()
    assert [(r.id, r.split, r.performer) for r in got] == [("a", "train", None), ("d", "test", None)]
    lists = B.splits(as_files(spark, set=b'{"train": ["b", "a"], "test": []}'))
    assert sorted((r.dataset, r.split, r.place, r.stem) for r in lists.collect()) == [("set", "train", 0, "b"), ("set", "train", 1, "a")]
    B.write_splits(lists, str(tmp_path / "s"))
    assert spark.read.json(str(tmp_path / "s")).collect()[0].stems == ["a", "b"]
    paths = spark.createDataFrame([("SET/item/x.gp5",), ("  ",), (None,), ("y",)], "p string")
    assert [r[0] for r in paths.select(B.resolved("p", "SET/")).collect()] == ["item/x.gp5", None, None, "y"]
    found = spark.createDataFrame([("/a/t1.wav", "t1"), ("/b/t1.mid", "t1"), ("/a/t2.wav", "t2"), ("/a/t3.wav", "t3"), ("/b/t3.mid", "t3")], "path string, stem string")
    assert [r.stem for r in B.takes(found, ["t3"]).collect()] == ["t1"]


def test_frames_replace_their_dataset_alone(spark, tmp_path):
    path = str(tmp_path / "f")
    B.write_frames(spark.createDataFrame([("a", 1), ("b", 2)], "dataset string, frame long"), path)
    B.write_frames(spark.createDataFrame([("b", 3)], "dataset string, frame long"), path)
    assert sorted((r.dataset, r.frame) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 3)]


def test_audio_and_arrays(spark):
    t = np.arange(44_100) / 44_100
    tone = np.sin(2 * np.pi * 440 * t)
    raw = io.BytesIO()
    with wave.open(raw, "wb") as f:
        f.setnchannels(2)
        f.setsampwidth(2)
        f.setframerate(44_100)
        f.writeframes((np.stack([tone, tone], axis=1) * 20_000).astype("<i2").tobytes())
    rows = B.audio_chunks(as_files(spark, a=raw.getvalue(), b=b"RIFF"), 22_050, 256, 32).orderBy("chunk").collect()
    x = np.concatenate([r.samples for r in rows if r.reason is None])
    assert len(x) == 22_050 // 256 * 256 and len([r for r in rows if r.reason]) == 1
    want = np.sin(2 * np.pi * 440 * np.arange(len(x)) / 22_050) * 20_000 / 32_768
    assert np.abs(x - want)[200:-200].max() < 0.01
    saved = io.BytesIO()
    np.save(saved, np.arange(6).reshape(2, 3))
    got = B.npy_arrays(as_files(spark, a=saved.getvalue(), b=b"x")).collect()
    assert sorted((r.row, r["values"]) for r in got if r.reason is None) == [(0, [0, 1, 2]), (1, [3, 4, 5])]


def test_binary_files_keep_their_names(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "take.one.wav").write_bytes(b"abc")
    r = S.binary(spark, str(tmp_path), "*.wav").collect()[0]
    assert r.stem == "take.one" and bytes(r.content) == b"abc"


def test_streaming_windows(spark, tmp_path):
    from pyspark.sql import functions as F

    from chronogrid.streaming import windows as W

    src = spark.range(100).select((F.timestamp_seconds(F.col("id") * 30 + F.when(F.col("id") >= 50, 10_000).otherwise(0))).alias("ts"), (F.col("id") % 2).alias("user"), F.col("id").cast("double").alias("value"))
    src.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(src.schema).parquet(str(tmp_path / "in"))
    for name, df in (("tumbling", W.tumbling(stream, "ts", "10 minutes", "1 hour", ["user"])), ("clusters", W.clusters(stream, "ts", "5 minutes", "1 hour", ["user"]))):
        q = df.writeStream.outputMode("complete" if name == "tumbling" else "append").format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination()
    sounding = W.any_sounding(stream.withColumn("voiced", F.col("value") > 50), "ts", "1 hour", ["user"])
    assert sounding.isStreaming and sounding.columns == ["user", "any_voiced"]
    assert spark.table("tumbling").agg(F.sum("n")).first()[0] == 100
    assert sorted((r.user, r.n) for r in spark.table("clusters").collect()) in ([(0, 25), (1, 25)], [(0, 25), (0, 25), (1, 25), (1, 25)])


def listing(spark, rows):
    return spark.createDataFrame([(p, p.rsplit("/", 1)[1].rsplit(".", 1)[0], bytearray(c)) for p, c in rows], "path string, stem string, content binary")


def test_any_error_of_a_file_is_its_reason(spark):
    files = listing(spark, [("/x/a.json", b'{"tempo": 100}'), ("/x/b.json", b"no"), ("/x/c.json", b'{"tempo": 100, "tuning": {"1": 64}, "measures": []}'), ("/x/d.json", b"[1]")])
    got = {r.stem: r.reason for r in X.read_tempos(files).collect()}
    assert got["a"] == "KeyError: 'tuning'" and got["b"].startswith("not JSON") and got["c"] is None and got["d"].startswith("TypeError")


def test_json_that_cannot_be_read_has_a_reason(spark):
    good = b'{"annotations": [{"namespace": "pitch_contour", "data": []}]}'
    files = listing(spark, [("/x/a.jams", b"{broken"), ("/x/b.jams", b'{"annotations": [{"namespace": "beat", "data": []}]}'), ("/x/c.jams", good), ("/x/d.jams", b""), ("/x/e.jams", b"{}")])
    got = {(r.stem, r.reason) for r in B.jams_problems(files).collect()}
    assert got == {("a", "not JSON"), ("d", "not JSON"), ("b", "no pitch contour"), ("e", "no pitch contour")}
    assert {r.stem for r in B.json_problems(files).collect()} == {"a", "d"}


def test_takes_are_paired_by_their_naming(spark):
    names = ["P1/audio/directinput/directinput_Chords.wav", "P1/midi/midi_Chords.mid", "P1/audio/directinput/directinput_Vibrato.wav", "P1/midi/midi_Vibrato.mid", "P2/audio/directinput/directinput_Scales.wav", "P2/video/ego/ego_Chords.mp3", "P2/midi/midi_Chords.mid", "Q1/audio/directinput/directinput_X.wav", "Q1/midi/midi_X.mid"]
    files = listing(spark, [(f"file:/raw/{n}", b"") for n in names])
    both, lonely = B.paired(files, B.NAMINGS["directinput"], ["Vibrato"])
    assert [(r.stem, r.audio[-10:], r.notes[-10:]) for r in both.collect()] == [("P1_Chords", "Chords.wav", "Chords.mid")]
    assert {tuple(r) for r in lonely.collect()} == {("P2_Scales", "no notes")}
    assert [r.stem for r in B.paired(files, B.NAMINGS["ego"])[0].collect()] == ["P2_Chords"]
    files = listing(spark, [(f"file:/raw/deep/{n}", b"") for n in ("00_a_mic.wav", "00_a_mix.wav", "00_a.jams", "01_b_mic.wav")])
    both, lonely = B.paired(files, B.NAMINGS["mic"])
    assert [(r.stem, r.audio) for r in both.collect()] == [("00_a", "file:/raw/deep/00_a_mic.wav")] and [r.stem for r in lonely.collect()] == ["01_b"]


def test_paths_of_files_that_are_not_there_are_null(spark):
    files = listing(spark, [("file:/root/data/item_0/item_0.gp5", b"")])
    rows = [(1, "GOAT/item_0/item_0.gp5"), (2, " "), (3, None), (4, "GOAT/item_1/item_1.gp5"), (5, "item_0/item_0.gp5")]
    df = spark.createDataFrame(rows, "k int, gp string").withColumn("gp", B.resolved("gp", "GOAT/"))
    got = {r.k: r.gp for r in B.existing(df, "gp", files, "/root/data").collect()}
    there = "file:/root/data/item_0/item_0.gp5"
    assert got == {1: there, 2: None, 3: None, 4: None, 5: there}


def test_cached_tracks_name_what_is_missing(spark):
    names = ["a-audio", "a-pitch", "a-voiced", "a-onset", "b-pitch", "c-d-audio", "c-d-pitch", "c-d-voiced"]
    got = {r.stem: (r.missing, r.has_onset) for r in B.missing_parts(listing(spark, [(f"file:/c/{n}.npy", b"") for n in names])).collect()}
    assert got == {"a": (None, True), "b": ("audio, voiced", False), "c-d": (None, False)}


def riff(form, bits, data, channels=1, rate=8000, extra=b""):
    fmt = struct.pack("<HHIIHH", form, channels, rate, rate * channels * bits // 8, channels * bits // 8, bits) + extra
    body = b"WAVE" + b"LIST" + struct.pack("<I", 3) + b"abc\0" + b"fmt " + struct.pack("<I", len(fmt)) + fmt + b"data" + struct.pack("<I", len(data)) + data
    return b"RIFF" + struct.pack("<I", len(body)) + body


def test_wave_files_of_every_sample_format():
    x = np.array([0.0, 0.5, -0.5, 0.25, -1.0, 0.75])
    for form, bits, data in ((3, 32, x.astype("<f4").tobytes()), (3, 64, x.astype("<f8").tobytes()), (1, 16, (x * 2**15).astype("<i2").tobytes()), (1, 32, (x * 2**31).astype("<i4").tobytes()), (1, 8, (x * 128 + 128).astype(np.uint8).tobytes())):
        assert B.decode_wav(riff(form, bits, data), 8000).tolist() == x.tolist()
        assert B.decode_wav(riff(form, bits, data, channels=2), 8000).tolist() == [0.25, -0.125, -0.125]
    wide = struct.pack("<HHI", 22, bits, 4) + struct.pack("<H", 3) + b"\0" * 14
    assert B.decode_wav(riff(0xFFFE, 32, x.astype("<f4").tobytes(), extra=wide), 8000).tolist() == x.tolist()
    for bad in (b"", b"RIFF1234WAVE", riff(2, 4, b"1234"), riff(1, 12, b"123456"), b"ID3" + b"0" * 60):
        with pytest.raises(ValueError):
            B.decode_wav(bad, 8000)

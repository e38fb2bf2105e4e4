import wave

import numpy as np
import pytest

from chronogrid import __main__ as cli
from chronogrid.operators import notes as N
from chronogrid.plans import datasets, recipes, reports
from tests.test_kernels import HOP, RATE, scene
from tests.test_sources import smf


@pytest.fixture(scope="module")
def place(tmp_path_factory):
    d = tmp_path_factory.mktemp("cli")
    (d / "src").mkdir()
    data = smf([[(0, b"\xff\x51\x03" + (1_000_000).to_bytes(3, "big"))], [(480, b"\x90\x40\x50"), (240, b"\x80\x40\0")]])
    for stem in ("04_a", "05_b", "00_c"):
        (d / "src" / f"{stem}.mid").write_bytes(data)
    (d / "lengths.csv").write_text("stem,n_frames\n04_a,400\n05_b,400\n00_c,400\n")
    (d / "src" / "lengths.csv").write_text((d / "lengths.csv").read_text())
    return d


def test_frames_splits_and_items(spark, place):
    cli.main(["frames", "strings", f"{place}/src", f"{place}/frames", "--hop-ms", "10", "--latency-ms", "0"])
    assert spark.read.parquet(f"{place}/frames").groupBy("stem").count().collect()[0]["count"] == 50
    cli.main(["split", "player", f"{place}/frames", f"{place}/split"])
    assert {(r.stem, r.split) for r in spark.read.parquet(f"{place}/split").collect()} == {("04_a", "valid"), ("05_b", "test"), ("00_c", "train")}
    for kind, rows in (("held-out", 4), ("folds", 18), ("random", 3)):
        cli.main(["split", kind, f"{place}/frames", f"{place}/{kind}"])
        assert spark.read.parquet(f"{place}/{kind}").count() == rows
    cli.main(["items", f"{place}/frames", f"{place}/split", f"{place}/items", "--lengths", f"{place}/lengths.csv", "--tiles", "--window", "100"])
    assert spark.read.parquet(f"{place}/items").count() == 12


def test_alignment_is_recorded_and_not_repeated(spark, tmp_path):
    audio, truth, notes = scene(17.0)
    (tmp_path / "audio").mkdir()
    with wave.open(str(tmp_path / "audio" / "a.wav"), "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(2)
        f.setframerate(RATE)
        f.writeframes((np.clip(audio, -1, 1) * 32_000).astype("<i2").tobytes())
    (tmp_path / "n.csv").write_text(f"stem,n_frames\na,{len(audio) // HOP}\n")
    rows = [("a", x.string, f, x.f0, True, f == x.frame) for x in notes for f in range(x.frame, x.frame + 30)]
    spark.createDataFrame(rows, "stem string, string int, frame long, pitch double, voiced boolean, onset boolean").write.parquet(str(tmp_path / "frames"))
    common = ["--audio", str(tmp_path / "audio"), "--lengths", str(tmp_path / "n.csv"), "--rate", str(RATE), "--hop", str(HOP)]
    cli.main(["align", "measure", str(tmp_path / "frames"), str(tmp_path / "measure"), *common])
    r = spark.read.parquet(str(tmp_path / "measure")).first()
    assert r.measured == r.tracks == 1 and r.suggested_frames == -3
    cli.main(["align", "apply", str(tmp_path / "frames"), str(tmp_path / "out"), "--mode", "constant", "--shift-ms", "-17.4", *common])
    got = {x.frame for x in spark.read.parquet(str(tmp_path / "out" / "frames")).where("onset").collect()}
    assert got == {x.frame - 3 for x in notes} and spark.read.parquet(str(tmp_path / "out" / "record")).first().shift_frames == -3
    with pytest.raises(ValueError, match="corrected before"):
        cli.main(["align", "apply", str(tmp_path / "out"), str(tmp_path / "out2"), "--mode", "constant", "--shift-ms", "5", *common])
    with pytest.raises(ValueError, match="not empty"):
        cli.main(["align", "apply", str(tmp_path / "frames"), str(tmp_path / "out"), "--mode", "constant", "--shift-ms", "5", *common])
    with pytest.raises(ValueError, match="the same"):
        cli.main(["align", "apply", str(tmp_path / "frames"), str(tmp_path / "frames"), "--mode", "constant", "--shift-ms", "5", *common])
    with pytest.raises(SystemExit):
        cli.main(["align", "apply", "x", "y", "--mode", "snap", "--shift-ms", "5", *common])


def test_action_counts_name_every_action(spark):
    rows = reports.action_counts(spark.createDataFrame([("flattened",), ("flattened",)], "action string")).collect()
    assert {r.action: r.n for r in rows} == dict.fromkeys(N.ACTIONS, 0) | {"flattened": 2}


def test_summaries(spark):
    moved = reports.moves_summary(spark.createDataFrame([("a", -3), ("b", -3), ("c", 0), ("d", -3)], "stem string, by long"))
    assert {r.by: (r.n, r.share) for r in moved.collect()} == {-3: (3, 0.75), 0: (1, 0.25)}
    status = reports.status_summary(spark.createDataFrame([("precise",), ("kept",)], "status string"))
    assert {r.status: r.n for r in status.collect()} == {"precise": 1, "kept": 1}
    low = recipes.implausible(spark.createDataFrame([(0, 39), (0, 40), (5, 63), (5, 64)], "string int, pitch int"), {0: 40, 5: 64})
    assert sorted(map(tuple, low.collect())) == [(0, 39), (5, 63)]


def test_manifests_say_what_was_left_out(spark, place, tmp_path):
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "a.mid").write_bytes((place / "src" / "04_a.mid").read_bytes())
    (tmp_path / "src" / "b.mid").write_bytes(b"broken")
    (tmp_path / "src" / "lengths.csv").write_text("stem,n_frames\na,400\nb,400\nc,400\n")
    cli.main(["frames", "strings", f"{tmp_path}/src", f"{tmp_path}/frames/", "--hop-ms", "10"])
    rows = {r.stem: (r.status, r.reason) for r in spark.read.parquet(f"{tmp_path}/frames-manifest/tracks").collect()}
    assert rows["a"] == ("included", None) and rows["b"][0] == "excluded" and rows["c"] == ("excluded", "missing midi")
    settings = {r.name: r.value for r in spark.read.parquet(f"{tmp_path}/frames-manifest/parameters").collect()}
    assert settings["kind"] == "strings" and settings["hop_ms"] == "10.0"
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "a.jams").write_text("{")
    (tmp_path / "j" / "lengths.csv").write_text("stem,n_frames\na,40\n")
    cli.main(["frames", "contours", f"{tmp_path}/j", f"{tmp_path}/f2"])
    assert spark.read.parquet(f"{tmp_path}/f2-manifest/tracks").first().reason == "not JSON"


def test_grouped_and_mirrored_splits_gate_list_and_kinds(spark, place, tmp_path, capsys):
    cli.main(["frames", "strings", f"{place}/src", f"{tmp_path}/frames", "--hop-ms", "10", "--latency-ms", "0"])
    (tmp_path / "p.csv").write_text("stem,performer\n04_a,x\n05_b,x\n00_c,\n")
    cli.main(["split", "grouped", f"{tmp_path}/frames", f"{tmp_path}/g", "--groups", f"{tmp_path}/p.csv", "--fraction", "0.3"])
    got = {r.stem: r.split for r in spark.read.parquet(f"{tmp_path}/g").collect()}
    assert got["04_a"] == got["05_b"] and set(got.values()) == {"train", "valid"}
    cli.main(["split", "mirror", f"{tmp_path}/frames", f"{tmp_path}/m", "--mirror", f"{tmp_path}/g"])
    assert {r.stem: r.split for r in spark.read.parquet(f"{tmp_path}/m").collect()} == got
    spark.createDataFrame([("04_a", "train"), ("zz", "test")], "stem string, split string").write.parquet(f"{tmp_path}/other")
    for wrong in (["split", "mirror", f"{tmp_path}/frames", f"{tmp_path}/m2", "--mirror", f"{tmp_path}/other"], ["split", "mirror", f"{tmp_path}/frames", f"{tmp_path}/m2"], ["split", "grouped", f"{tmp_path}/frames", f"{tmp_path}/m2"]):
        with pytest.raises(SystemExit):
            cli.main(wrong)
    (tmp_path / "t.csv").write_text("item,fine,coarse,score\n1,f1,c1,0.9\n2,f2,c2,0.1\n3, ,c3,\n4,,,\n")
    cli.main(["gate", f"{tmp_path}/t.csv", f"{tmp_path}/gate"])
    assert {r.stem: r.notes for r in spark.read.parquet(f"{tmp_path}/gate/tracks").collect()} == {"1": "f1", "2": None, "3": "c3", "4": None}
    cli.main(["list", f"{tmp_path}/frames"])
    cli.main(["kinds"])
    said = capsys.readouterr().out
    assert "04_a" in said and "tablature" in said
    with pytest.raises(ValueError, match="one of"):
        datasets.kind("strings").naming("nothing")


def test_carried_tables_and_plot_slices(spark, tmp_path):
    rows = [("a", s, f, 100.0 + s if f % 3 else 0.0, bool(f % 3), f % 3 == 1) for s in range(2) for f in range(30)]
    frames = spark.createDataFrame(rows, "stem string, string int, frame long, pitch double, voiced boolean, onset boolean")
    for name in ("frames", "audio"):
        frames.write.parquet(f"{tmp_path}/one/{name}")
    reports.write_corrected(frames, {"mode": "constant"}, f"{tmp_path}/one", f"{tmp_path}/two")
    assert reports.carry_over(spark, f"{tmp_path}/one", f"{tmp_path}/two", ["frames", "audio", "extra"]) == ["audio"]
    assert reports.located(spark, f"{tmp_path}/two", "audio") == f"{tmp_path}/one/audio"
    assert reports.located(spark, f"{tmp_path}/two", "frames") == f"{tmp_path}/two/frames"
    with pytest.raises(ValueError):
        reports.located(spark, f"{tmp_path}/two", "extra")
    window = reports.frame_window(0.05, 0.06, 0.01, 30)
    got = reports.plot_slice(frames, "a", window, 0.01).orderBy("string", "frame").collect()
    assert window == (5, 11) and len(got) == 12
    for r in got:
        assert r.pitch == (100.0 + r.string if r.frame % 3 else None) and r.onset_pitch == (100.0 + r.string if r.frame % 3 == 1 else None)
    assert reports.plot_slice(frames.drop("onset"), "a", window, 0.01).where("onset_pitch IS NOT NULL").count() == 0
    with pytest.raises(ValueError, match="empty"):
        reports.frame_window(1.0, 1.0, 0.01, 30)

"""Command line over the recipes.

    python -m chronogrid frames contours|scores|tablature|strings SOURCE TARGET
    python -m chronogrid split player|held-out|folds|random|grouped|mirror FRAMES TARGET
    python -m chronogrid items FRAMES SPLIT TARGET
    python -m chronogrid align measure|apply FRAMES TARGET --audio AUDIO
    python -m chronogrid gate TAKES TARGET
    python -m chronogrid list FRAMES
    python -m chronogrid kinds

SOURCE holds the annotation files and ``lengths.csv`` (stem, n_frames). Tables are
Parquet; ``frames`` writes its manifest (tracks with reasons, and parameters) beside
TARGET, as TARGET-manifest. TAKES is a CSV of item, fine, coarse and score.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession, functions as F

from .functions import scalars as X
from .operators import splits
from .plans import datasets, recipes, reports
from .sources import files, midi, tables


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="chronogrid", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="command", required=True)
    f = sub.add_parser("frames")
    f.add_argument("kind", choices=("contours", "scores", "tablature", "strings"))
    f.add_argument("source")
    f.add_argument("target")
    f.add_argument("--dataset", default="dataset")
    f.add_argument("--hop-ms", type=float, default=recipes.HOP / recipes.RATE * 1000)
    f.add_argument("--tolerance", type=float, default=2.0)
    f.add_argument("--flatten-tails", action="store_true")
    f.add_argument("--remove-overhangs", action="store_true")
    f.add_argument("--keep-mismatch", action="store_true")
    f.add_argument("--latency-ms", type=float, default=23.0)
    s = sub.add_parser("split")
    s.add_argument("kind", choices=("player", "held-out", "folds", "random", "grouped", "mirror"))
    s.add_argument("frames")
    s.add_argument("target")
    s.add_argument("--valid", nargs="*", default=["04"])
    s.add_argument("--test", nargs="*", default=["05"])
    s.add_argument("--prefix", type=int, default=2, help="characters of a stem that name its player")
    s.add_argument("--folds", type=int, default=6)
    s.add_argument("--seed", type=int, default=42)
    s.add_argument("--groups", help="CSV of stem and performer, for grouped")
    s.add_argument("--fraction", type=float, default=0.1, help="share of tracks that grouped holds out")
    s.add_argument("--mirror", help="split to copy, for mirror")
    i = sub.add_parser("items")
    i.add_argument("frames")
    i.add_argument("split")
    i.add_argument("target")
    i.add_argument("--lengths", required=True)
    i.add_argument("--window", type=int, default=recipes.WINDOW)
    i.add_argument("--batch", type=int, default=32)
    i.add_argument("--seed", type=int, default=0)
    i.add_argument("--epoch", type=int, default=0)
    i.add_argument("--tiles", action="store_true")
    i.add_argument("--onsets", action="store_true")
    a = sub.add_parser("align")
    a.add_argument("kind", choices=("measure", "apply"))
    a.add_argument("frames")
    a.add_argument("target")
    a.add_argument("--audio", required=True)
    a.add_argument("--lengths", required=True)
    a.add_argument("--mode", choices=("constant", "per-track", "snap"), default="per-track")
    a.add_argument("--shift-ms", type=float)
    a.add_argument("--rate", type=int, default=recipes.RATE)
    a.add_argument("--hop", type=int, default=recipes.HOP)
    a.add_argument("--force", action="store_true")
    g = sub.add_parser("gate")
    g.add_argument("takes")
    g.add_argument("target")
    g.add_argument("--threshold", type=float, default=recipes.GATE)
    g.add_argument("--disable-unaligned", action="store_true")
    sub.add_parser("list").add_argument("frames")
    sub.add_parser("kinds")
    return p


def lengths(spark: SparkSession, path: str) -> DataFrame:
    df = tables.metadata(spark, path, ["stem", "n_frames"])
    return df.select("stem", F.col("n_frames").cast("long").alias("n_frames"))


def frames(spark: SparkSession, a: argparse.Namespace) -> None:
    datasets.kind(a.kind)
    size, hop = lengths(spark, f"{a.source}/lengths.csv"), a.hop_ms / 1000
    read = lambda pattern: files.binary(spark, a.source, pattern)
    listed = size.select("stem")
    if a.kind == "contours":
        jams = read("*.jams")
        out = recipes.contour_frames(jams, size, hop, flatten=a.flatten_tails, trim=a.remove_overhangs)
        report = recipes.reasons(listed, {"jams": jams}, tables.jams_problems(jams))
    elif a.kind == "scores":
        out, report = recipes.synced_score_frames(read("*.mid"), read("*.{xml,musicxml}"), read("*.json"), size, hop, a.tolerance, a.keep_mismatch)
    elif a.kind == "tablature":
        out, report = recipes.tablature_frames(read("*.mid"), read("*.json"), size, hop, a.tolerance)
    else:
        midi_files = read("*.mid")
        out = recipes.string_midi_frames(midi_files, size, hop, a.latency_ms)
        report = recipes.reasons(listed, {"midi": midi_files}, midi.read_strings(midi_files, a.latency_ms).where("reason IS NOT NULL").select("stem", "reason"))
    tables.write_frames(out.withColumn("dataset", F.lit(a.dataset)), a.target)
    reports.write_manifest(report, {k: v for k, v in vars(a).items() if k != "command"}, f"{a.target.rstrip('/')}-manifest")
    reports.manifest_counts(spark, f"{a.target.rstrip('/')}-manifest").show(truncate=False)


def split(spark: SparkSession, a: argparse.Namespace) -> None:
    stems = spark.read.parquet(a.frames).select("stem").distinct()
    player = F.substring("stem", 1, a.prefix)
    if a.kind == "player":
        out = splits.by_group(stems, player, a.valid, a.test)
    elif a.kind == "held-out":
        out = splits.held_out(stems, player, a.test[0] if a.test else None)
    elif a.kind == "folds":
        out = splits.folds(stems, player.try_cast("int"), a.folds)
    elif a.kind == "grouped":
        if not a.groups or not 0 < a.fraction < 1:
            raise SystemExit("grouped wants --groups, and a --fraction between 0 and 1")
        performers = tables.metadata(spark, a.groups, ["stem", "performer"])
        out = splits.grouped_valid(stems.join(performers, "stem", "left"), "stem", "performer", a.seed, a.fraction).select("stem", "split")
    elif a.kind == "mirror":
        if not a.mirror:
            raise SystemExit("mirror wants the split to --mirror")
        out = spark.read.parquet(a.mirror)
        lacks = [r["stem"] for r in splits.mirrored(out.select("stem").distinct(), stems, "stem").orderBy("stem").limit(5).collect()]
        if lacks:
            raise SystemExit(f"the split names tracks that {a.frames} has not: {', '.join(lacks)} ...")
    else:
        out = splits.random_split(stems, "stem", a.seed).drop("place")
    out.write.mode("overwrite").parquet(a.target)


def gate(spark: SparkSession, a: argparse.Namespace) -> None:
    takes = tables.metadata(spark, a.takes, ["item", "fine", "coarse", "score"])
    named = takes.select(F.col("item").alias("stem"), *[X.blank_to_null(c).alias(c) for c in ("fine", "coarse")], "score")
    out = recipes.gated(named, a.threshold, not a.disable_unaligned)
    reports.write_manifest(out, {"threshold": a.threshold, "disable_unaligned": a.disable_unaligned}, a.target)
    reports.manifest_counts(spark, a.target).show(truncate=False)


def list_(spark: SparkSession, a: argparse.Namespace) -> None:
    spark.read.parquet(a.frames).groupBy("stem").agg(F.count("*").alias("frames"), F.max("frame").alias("last")).orderBy("stem").show(1000, truncate=False)


def kinds(spark: SparkSession, a: argparse.Namespace) -> None:
    for name, k in datasets.KINDS.items():
        print(f"{name}: {k.about}; splits {', '.join(k.splits)}" + (f"; audio {', '.join(k.namings)}" if k.namings else ""))


def items(spark: SparkSession, a: argparse.Namespace) -> None:
    out = recipes.items(spark.read.parquet(a.frames), lengths(spark, a.lengths), spark.read.parquet(a.split), a.window, not a.tiles, a.onsets, a.seed, a.epoch, a.batch)
    out.write.mode("overwrite").parquet(a.target)


def align(spark: SparkSession, a: argparse.Namespace) -> None:
    if (a.mode == "constant") != (a.shift_ms is not None):
        raise SystemExit("--shift-ms goes with --mode constant, and only with it")
    source = f"{a.frames}/frames" if reports.exists(spark, f"{a.frames}/record") else a.frames
    labels = spark.read.parquet(source)
    chunks = tables.audio_chunks(files.binary(spark, a.audio, "*.wav"), a.rate, a.hop).where("reason IS NULL")
    if a.kind == "measure":
        reports.prior_summary(recipes.measured(chunks, labels, a.rate, a.hop)[1], a.rate, a.hop).write.mode("overwrite").parquet(a.target)
        return
    by = round((a.shift_ms or 0) / (1000 * a.hop / a.rate))
    out = recipes.corrected(chunks, labels, lengths(spark, a.lengths), a.rate, a.hop, a.mode, by)
    reports.write_corrected(out, {"source": a.frames, "mode": a.mode, "shift_frames": by, "rate": a.rate, "hop": a.hop}, a.frames, a.target, a.force)


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("chronogrid").getOrCreate()
    {"frames": frames, "split": split, "items": items, "align": align, "gate": gate, "list": list_, "kinds": kinds}[a.command](spark, a)


if __name__ == "__main__":
    main()

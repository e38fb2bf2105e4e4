"""Whole ways from annotation files to a frame grid, training windows and corrected labels.

Each recipe is a composition of operators over tables of many tracks at once. Tracks
that can't be used leave with a reason in a report table and stop nothing. Annotations
are judged before audio is touched, so audio is read for the tracks that stay alone.

Frames are (stem, string, frame, pitch, voiced, onset), sounding frames only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import scalars as X
from ..operators import aggregates as A, grid as G, joins as J, notes as N, sequences as S, splits as P, tracks as T
from ..sources import midi, scores, tables

#: Sample rate and hop of the grid, frames of a window, gate of a take's alignment score.
RATE, HOP, WINDOW, GATE = 22_050, 256, 32, 0.5


def contour_frames(jams: DataFrame, lengths: DataFrame, hop_seconds: float, native_hop: float = HOP / 44_100, flatten: bool = False, trim: bool = False) -> DataFrame:
    """Pitch contours of JAMS files on the grid, with note_id. ``lengths``: stem, n_frames.

    Observations are cut into notes where their index changes or time jumps by more than
    two native hops, and each note is read at the grid's times; where notes meet the later
    one holds the frame. Onsets are told before drops are flattened and overhangs trimmed.
    """
    keys = ["stem", "string"]
    obs = S.segments(tables.jams_observations(jams), keys, ["time", "idx"], "time", "note_id", 2 * native_hop, "segment")
    read = G.resample(obs, [*keys, "segment"], ["time", "idx"], "time", "frequency", hop_seconds)
    inside = read.join(lengths, "stem").where("frame >= 0 AND frame < n_frames")
    frames = inside.groupBy(*keys, "frame").agg(F.max(F.struct("segment", "frequency")).alias("w")).select(*keys, "frame", F.col("w.frequency").alias("pitch"), F.col("w.segment").alias("note_id"))
    w = Window.partitionBy(*keys).orderBy("frame")
    follows = (F.lag("frame").over(w) == F.col("frame") - 1) & (F.lag("note_id").over(w) == F.col("note_id"))
    frames = frames.withColumn("voiced", F.lit(True)).withColumn("onset", ~F.coalesce(follows, F.lit(False)))
    if flatten:
        frames = N.flatten(frames, [*keys, "note_id"], "frame", "pitch", hop_seconds * 1000)
    if trim:
        frames = N.overhangs(frames, [*keys, "note_id"], "frame", "pitch").where("NOT silent").drop("silent")
    return frames


def reasons(stems: DataFrame, parts: dict[str, DataFrame], problems: DataFrame) -> DataFrame:
    """(stem, reason) of all stems: the first part that is missing, else the first of its problems (stem, reason), else null."""
    lacks = J.first_missing(stems, parts, ["stem"], "__lacks")
    found = problems.groupBy("stem").agg(F.min("reason").alias("__problem"))
    return lacks.join(found, "stem", "left").select("stem", F.when(F.col("__lacks").isNotNull(), F.concat(F.lit("missing "), "__lacks")).otherwise(F.col("__problem")).alias("reason"))


def measures_agree(score: DataFrame, sync: DataFrame) -> DataFrame:
    """(stem, expected, performed, agrees): last synced measure against the last of the score, one off allowed; a track without sync points agrees."""
    have = score.groupBy("stem").agg((F.max("measure") + 1).alias("performed"))
    want = sync.where("offset IS NULL").groupBy("stem").agg((F.max("measure") + 1).cast("long").alias("expected"))
    both = have.join(want, "stem", "left")
    return both.withColumn("agrees", F.col("expected").isNull() | (F.abs(F.col("performed") - F.col("expected")) <= 1))


def predicted_times(score: DataFrame, sync: DataFrame) -> DataFrame:
    """Score notes with ``time``: their position between the sync points, held at the ends. A measure's length is its last note's, 1 without notes."""
    last = score.groupBy("stem", "measure").agg(F.max(F.struct("idx", "measure_len")).alias("l")).select("stem", F.col("measure").cast("double").alias("measure"), F.col("l.measure_len").alias("len"))
    anchors = sync.join(last, ["stem", "measure"], "left").withColumn("x", X.position("measure", F.coalesce("offset", F.lit(0.0)), F.coalesce("len", F.lit(1))))
    notes = score.withColumn("x", X.position("measure", "offset", "measure_len"))
    return G.interpolate(notes, anchors.withColumnRenamed("x", "ax"), ["stem"], "x", "ax", "seconds", ["idx"], "time").drop("x")


def tunings(score: DataFrame, declared: DataFrame | None = None) -> DataFrame:
    """(stem, string, open) with strings from 0, the lowest: as declared, or per string the most frequent pitch less fret where a track declares none."""
    guessed = A.mode_first_seen(score.withColumn("open", F.col("pitch") - F.col("fret")), ["stem", "string"], "open", ["idx"]).select("stem", "string", "open")
    if declared is not None:
        guessed = declared.select("stem", "string", "open").unionByName(J.missing(guessed, declared, ["stem"]))
    return guessed.select("stem", X.string_index("string").alias("string"), F.col("open").cast("int").alias("open"))


def placed_notes(played: DataFrame, score: DataFrame, tuning: DataFrame, tolerance: float = 2.0) -> DataFrame:
    """Played notes (stem, idx, onset, offset, pitch) with string and given: of the score note (with time) they align to, else the lowest free fret."""
    pairs = T.monotone_align(played.withColumnRenamed("onset", "time"), score, ["stem"], tolerance)
    strings = pairs.join(score.select("stem", F.col("idx").alias("other_idx"), X.string_index("string").alias("string")), ["stem", "other_idx"]).select("stem", "idx", "string")
    marked = played.join(strings, ["stem", "idx"], "left")
    return played.join(T.assign_strings(marked, tuning, ["stem"]), ["stem", "idx"])


def note_grid(notes: DataFrame, lengths: DataFrame, hop_seconds: float, variant: str = "late", cents: float = 0.0) -> DataFrame:
    """Notes (stem, string, idx, onset, offset, pitch) as frames; those without a string (-1) are left out. ``continues``, if there, takes a note's onset away."""
    placed = G.note_frames(notes.where("string >= 0").join(lengths, "stem"), "onset", "offset", hop_seconds, "n_frames", variant)
    fresh = ~F.col("continues") if "continues" in notes.columns else None
    frames = G.rasterise(placed, ["stem", "string"], ["idx"], "pitch", fresh)
    return frames.withColumn("pitch", (X.midi_to_hz("pitch") * X.tuning_scale(F.lit(cents))).cast("float")).withColumn("voiced", F.lit(True))


def synced_score_frames(midi_files: DataFrame, score_files: DataFrame, sync_files: DataFrame, lengths: DataFrame, hop_seconds: float, tolerance: float = 2.0, keep_mismatch: bool = False) -> tuple[DataFrame, DataFrame]:
    """(frames, report) of tracks with performed MIDI, a score and sync points.

    Report: stem, status (included, excluded), reason: a missing part, a file that can't
    be read, fewer than two sync points, or measures that disagree.
    """
    played, score, sync = midi.read_merged(midi_files), scores.read_musicxml(score_files), tables.sync_points(sync_files)
    bad = played.where("reason IS NOT NULL").select("stem", "reason").unionByName(score.where("reason IS NOT NULL").select("stem", "reason")).unionByName(tables.json_problems(sync_files))
    played, score = played.where("reason IS NULL").drop("reason"), score.where("reason IS NULL").drop("reason")
    report = reasons(lengths.select("stem"), {"midi": midi_files, "score": score_files, "sync": sync_files}, bad)
    report = report.join(sync.groupBy("stem").agg(F.countDistinct("measure", F.coalesce("offset", F.lit(0.0))).alias("points")), "stem", "left").join(measures_agree(score, sync).select("stem", "agrees"), "stem", "left")
    reason = F.when(F.col("reason").isNotNull(), F.col("reason")).when(F.coalesce("points", F.lit(0)) < 2, "fewer than two sync points")
    if not keep_mismatch:
        reason = reason.when(~F.coalesce("agrees", F.lit(True)), "measures disagree")
    report = report.select("stem", reason.alias("reason")).withColumn("status", F.when(F.col("reason").isNull(), "included").otherwise("excluded"))
    good = report.where("reason IS NULL").select("stem")
    played, score, sync = (J.present(x, good, ["stem"]) for x in (played, score, sync))
    declared = scores.read_tunings(J.present(score_files, good, ["stem"])).where("reason IS NULL")
    notes = placed_notes(played, predicted_times(score, sync), tunings(score, declared), tolerance)
    return note_grid(notes, lengths, hop_seconds), report


def gated(takes: DataFrame, threshold: float = GATE, unaligned: bool = True) -> DataFrame:
    """Takes (fine, coarse, score: paths and alignment score as text) with ``notes``, the path to use, or a reason.

    A fine alignment is used from ``threshold`` on, or with a blank score; without a fine
    one the coarse is, unless that is not wanted.
    """
    f = F.expr("try_cast(nullif(trim(score), '') AS double)")
    use = F.when(F.col("fine").isNotNull(), F.when(f.isNull() | (f >= threshold), F.col("fine"))).when(F.lit(unaligned), F.col("coarse"))
    reason = F.when(F.col("fine").isNotNull() & (f < threshold), "alignment score too low").when(F.col("fine").isNull() & (F.col("coarse").isNull() | F.lit(not unaligned)), "no notes")
    return takes.withColumn("notes", use).withColumn("reason", reason)


def tablature_frames(midi_files: DataFrame, tab_files: DataFrame, lengths: DataFrame, hop_seconds: float, tolerance: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """(frames, report) of takes with MIDI and tablature: the score is shifted as the pitches say, timed by its tempos, and aligned. Report: stem, reason, shift."""
    played, tab = midi.read_merged(midi_files), scores.read_tablature(tab_files)
    bad = played.where("reason IS NOT NULL").select("stem", "reason").unionByName(tab.where("reason IS NOT NULL").select("stem", "reason")).groupBy("stem").agg(F.min("reason").alias("reason"))
    played, tab = (J.missing(x.where("reason IS NULL").drop("reason"), bad, ["stem"]) for x in (played, tab))
    shifts = J.best_shift(tab, played, ["stem"], "pitch", 12)
    moved = tab.join(shifts, "stem").withColumn("pitch", (F.col("pitch") + F.col("shift")).cast("int"))
    tempos = scores.read_tempos(tab_files).where("reason IS NULL").select("stem", "tick", "bpm")
    timed = S.ticks_to_seconds(moved, S.tempo_sections(tempos, ["stem"], "tick", "bpm", 960), ["stem"], "tick", "time")
    notes = placed_notes(played, timed, tunings(moved), tolerance)
    report = lengths.select("stem").join(bad, "stem", "left").join(shifts, "stem", "left")
    return note_grid(notes, lengths, hop_seconds, "early"), report


def string_midi_frames(midi_files: DataFrame, lengths: DataFrame, hop_seconds: float, latency_ms: float = midi.LATENCY_MS, merge_ms: float = 50.0, cents: float = 0.0) -> DataFrame:
    """Frames of MIDI with a track a string; a note that starts within ``merge_ms`` of the end of its string's last one continues it."""
    notes = midi.read_strings(midi_files, latency_ms).where("reason IS NULL")
    marked = S.continuations(notes, ["stem", "string"], ["start", "idx"], "start", "end", merge_ms / 1000)
    return note_grid(marked.withColumnRenamed("start", "onset").withColumnRenamed("end", "offset"), lengths.where("n_frames > 0"), hop_seconds, cents=cents)


def implausible(notes: DataFrame, open_pitches: dict[int, int]) -> DataFrame:
    """Notes below the open pitch of their string."""
    low = F.create_map(*[x for s, p in open_pitches.items() for x in (F.lit(s), F.lit(p))])
    return notes.where(F.col("pitch") < low[F.col("string")])


def items(frames: DataFrame, tracks: DataFrame, split: DataFrame, window: int = WINDOW, train: bool = True, onsets: bool = False, seed: int = 0, epoch: int = 0, batch: int = 32) -> DataFrame:
    """(stem, start, place, batch): windows to serve, in order.

    Training takes a window at each voiced (or onset) frame of tracks of at least a
    window, permuted for seed + epoch; otherwise tracks are tiled in order. ``tracks``:
    stem, n_frames; ``split``: the stems wanted.
    """
    wanted = J.present(tracks, split, ["stem"]).where(F.col("n_frames") >= window)
    if train:
        pool = (G.onset_pool if onsets else G.voiced_pool)(J.present(frames, wanted, ["stem"]), ["stem"]).withColumnRenamed("frame", "start")
        order = [P.hash_order(["stem", "start"], seed + epoch), "stem", "start"]
    else:
        pool, order = G.tiles(wanted, "n_frames", window).select("stem", "start"), ["stem", "start"]
    # Places are given in two steps, so no task sees the whole order: ranges first, then rows.
    ranged = pool.withColumn("key", order[0] if train else F.concat_ws("/", "stem", F.lpad(F.col("start").cast("string"), 19, "0")))
    ranged = ranged.withColumn("bucket", F.substring("key", 1, 2) if train else F.col("stem"))
    sizes = S.offsets(ranged.groupBy("bucket").agg(F.count("*").alias("n")), ["bucket"], "n", out="base")
    w = Window.partitionBy("bucket").orderBy("key", "stem", "start")
    placed = ranged.withColumn("inside", F.row_number().over(w) - 1).join(F.broadcast(sizes.select("bucket", "base")), "bucket")
    return P.batches(placed.select("stem", "start", (F.col("base") + F.col("inside")).cast("long").alias("place")), "place", batch)


def served(windows: DataFrame, packed: DataFrame, window: int = WINDOW, hop: int = HOP) -> DataFrame:
    """Windows with their arrays, zero past a track's grid. ``packed``: stem, n_frames, audio, and pitch, voiced, onset by string."""
    joined = windows.join(packed, "stem")
    grid = lambda c, pad: F.transform(c, lambda a: G.padded(a, F.col("start"), window, pad))
    audio = G.padded(F.slice("audio", F.lit(1), (F.col("n_frames") * hop).cast("int")), F.col("start") * hop, window * hop, 0.0)
    return joined.select("stem", "start", "place", "batch", audio.alias("audio"), grid("pitch", 0.0).alias("pitch"), grid("voiced", False).alias("voiced"), grid("onset", False).alias("onset"))


def measured(chunks: DataFrame, frames: DataFrame, rate: int, hop: int) -> tuple[DataFrame, DataFrame]:
    """(notes, priors): each track's notes (string, frame, f0 of the first frames) and its prior, or the pooled one."""
    w = Window.partitionBy("stem", "string").orderBy("frame")
    ahead = w.rangeBetween(0, 5)
    f0 = F.first(F.when(F.col("pitch") > 0, F.col("pitch")), ignorenulls=True).over(ahead)
    notes = frames.withColumn("f0", F.coalesce(f0, F.lit(0.0)).cast("double")).where("onset").select("stem", F.col("string").cast("int").alias("string"), "frame", "f0")
    own = T.track_priors(chunks, notes, ["stem"], rate, hop).select("stem", F.col("shift_ms").alias("shift"), F.col("jitter_ms").alias("jitter"), "anchors").where("shift IS NOT NULL")
    stems = chunks.select("stem").distinct()
    pooled = A.with_pooled(stems, own, ["stem"])
    return notes, pooled.select("stem", F.col("shift").alias("shift_ms"), F.col("jitter").alias("jitter_ms"), "anchors")


def shifted(frames: DataFrame, shifts: DataFrame, lengths: DataFrame) -> DataFrame:
    """Frames moved by their track's ``by`` frames (shifts: stem, by), what leaves the grid cut; a note cut at its start begins again at frame 0."""
    moved = frames.join(shifts, "stem").join(lengths, "stem").withColumn("frame", F.col("frame") + F.col("by")).where("frame >= 0 AND frame < n_frames")
    return moved.withColumn("onset", F.col("onset") | ((F.col("frame") == 0) & F.col("voiced") & (F.col("by") < 0))).drop("by", "n_frames")


def corrected(chunks: DataFrame, frames: DataFrame, lengths: DataFrame, rate: int, hop: int, mode: str, shift_frames: int = 0) -> DataFrame:
    """Frames with corrected timing. ``mode``: constant (``shift_frames`` for all), per-track (each track's prior), snap (as per-track, then each note to its attack)."""
    if mode not in ("constant", "per-track", "snap"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "constant":
        return shifted(frames, lengths.select("stem", F.lit(shift_frames).alias("by")), lengths)
    notes, priors = measured(chunks, frames, rate, hop)
    by = priors.select("stem", X.half_even(F.col("shift_ms") / (1000 * hop / rate)).alias("by"))
    moved = shifted(frames, by, lengths)
    if mode == "per-track":
        return moved
    snaps = T.snapped(chunks, notes, priors, ["stem"], rate, hop).where("sample IS NOT NULL")
    moves = snaps.join(by, "stem").select("stem", "string", F.greatest(F.lit(0), F.col("frame") + F.col("by")).alias("frame"), F.floor(F.col("sample") / hop).cast("long").alias("target"))
    dense = lengths.join(moved.select("stem", "string").distinct(), "stem").withColumn("frame", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_frames").cast("long") - 1))).drop("n_frames")
    full = dense.join(moved, ["stem", "string", "frame"], "left").fillna(0.0, ["pitch"]).fillna(False, ["voiced", "onset"])
    return T.move_starts(full, moves, ["stem", "string"]).where("voiced").drop("moved")

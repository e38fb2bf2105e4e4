"""Grouped operators: one track a group, its arrays in one Arrow transfer.

A track is bounded by its length (hours at most), not by the size of the catalogue, so a
group fits a task; tracks spread over the cluster.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions import kernels as K


def _schema(df: DataFrame, keys, more: str) -> str:
    return ", ".join([*(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys), more])


def _sorted(table: pa.Table, order, names) -> list[np.ndarray]:
    """Columns of a group as arrays, in order; a null number is not a number."""
    arrays = {n: table.column(n).to_numpy() for n in {*order, *names}}
    at = np.lexsort([arrays[n] for n in reversed(order)])
    return [arrays[n][at] for n in names]


def _table(keys, key, columns: dict[str, np.ndarray]) -> pa.Table:
    """Rows of a group: its keys, then the columns."""
    n = len(next(iter(columns.values())))
    held = {k: pa.array([v.as_py()] * n, v.type) for k, v in zip(keys, key, strict=True)}
    return pa.table(held | {k: pa.array(v) for k, v in columns.items()})


def monotone_align(left: DataFrame, right: DataFrame, keys, tolerance: float = 2.0, gap: float = -0.3, chord: float = 0.05) -> DataFrame:
    """(keys, idx, other_idx): order-preserving matches of events (keys, idx, time, pitch) of two sides.

    Indices say an event's place in its list and break ties. A track with one side alone
    has no matches.
    """

    def run(key, a: pa.Table, b: pa.Table) -> pa.Table:
        (idx, time, pitch), (other, other_time, other_pitch) = (_sorted(x, order, ("idx", "time", "pitch")) for x, order in ((a, ("time", "idx")), (b, ("idx",))))
        pairs = sorted(K.align(time, pitch, other_time, other_pitch, tolerance, gap, chord).items())
        return _table(keys, key, {"idx": idx[[i for i, _ in pairs]].astype("int64"), "other_idx": other[[j for _, j in pairs]].astype("int64")})

    columns = [*keys, "idx", "time", "pitch"]
    grouped = left.select(*columns).groupBy(*keys).cogroup(right.select(*columns).groupBy(*keys))
    return grouped.applyInArrow(run, _schema(left, keys, "idx long, other_idx long"))


def assign_strings(notes: DataFrame, tuning: DataFrame, keys, most_fret: int = K.MOST_FRET) -> DataFrame:
    """(keys, idx, string, given): strings of notes (keys, idx, onset, offset, pitch, string) under a tuning (keys, string, open).

    A null string is looked for; -1 where no string can play the note.
    """

    def run(key, a: pa.Table, b: pa.Table) -> pa.Table:
        idx, onset, offset, pitch, string = _sorted(a, ("idx",), ("idx", "onset", "offset", "pitch", "string"))
        have = np.where(np.isnan(string), -1, string).astype(int)
        tuned = dict(zip(b.column("string").to_pylist(), b.column("open").to_pylist(), strict=True))
        out = K.assign_strings(onset, offset, pitch, have, tuned, most_fret)
        return _table(keys, key, {"idx": idx.astype("int64"), "string": out.astype("int32"), "given": have >= 0})

    a = notes.select(*keys, "idx", "onset", "offset", "pitch", F.col("string").cast("double").alias("string")).groupBy(*keys)
    return a.cogroup(tuning.select(*keys, "string", "open").groupBy(*keys)).applyInArrow(run, _schema(notes, keys, "idx long, string int, given boolean"))


def move_starts(frames: DataFrame, moves: DataFrame, keys) -> DataFrame:
    """Frames (keys, frame, pitch, voiced, onset) of a string after moves (keys, frame, target), later notes first; ``moved`` counts those not refused."""

    def run(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        a = a.sort_values("frame")
        n = int(a["frame"].max()) + 1 if len(a) else 0
        onset, voiced, pitch = np.zeros(n, bool), np.zeros(n, bool), np.zeros(n)
        at = a["frame"].to_numpy()
        onset[at], voiced[at], pitch[at] = a["onset"], a["voiced"], a["pitch"]
        order = b.sort_values("frame", ascending=False)
        moved = sum(K.move_note_start(onset, voiced, pitch, int(f), int(t)) for f, t in zip(order["frame"], order["target"], strict=True))
        out = pd.DataFrame({"frame": np.arange(n), "pitch": pitch, "voiced": voiced, "onset": onset, "moved": moved})
        for k, v in zip(keys, key, strict=True):
            out[k] = v
        return out[[*keys, "frame", "pitch", "voiced", "onset", "moved"]]

    a = frames.select(*keys, "frame", F.col("pitch").cast("double").alias("pitch"), "voiced", "onset").groupBy(*keys)
    return a.cogroup(moves.select(*keys, "frame", "target").groupBy(*keys)).applyInPandas(run, _schema(frames, keys, "frame long, pitch double, voiced boolean, onset boolean, moved long"))


def _notes(b: pd.DataFrame) -> list[K.Note]:
    b = b.sort_values(["frame", "string"])
    return [K.Note(int(s), int(f), float(h)) for s, f, h in zip(b["string"], b["frame"], b["f0"], strict=True)]


def _audio(a: pd.DataFrame) -> np.ndarray:
    parts = [np.asarray(x, np.float32) for x in a.sort_values("chunk")["samples"]]
    return np.concatenate(parts) if parts else np.zeros(0, np.float32)


def track_priors(chunks: DataFrame, notes: DataFrame, keys, rate: int, hop: int) -> DataFrame:
    """(keys, shift_ms, jitter_ms, anchors) of tracks: audio (keys, chunk, samples) against notes (keys, string, frame, f0). Tracks with too few anchors have nulls."""

    def run(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        prior = K.estimate_prior(_audio(a), rate, hop, _notes(b))
        values = [*key, *(prior or (None, None, 0))]
        return pd.DataFrame([values], columns=[*keys, "shift_ms", "jitter_ms", "anchors"]).astype({"shift_ms": "float64", "jitter_ms": "float64"})

    grouped = chunks.select(*keys, "chunk", "samples").groupBy(*keys).cogroup(notes.select(*keys, "string", "frame", "f0").groupBy(*keys))
    return grouped.applyInPandas(run, _schema(chunks, keys, "shift_ms double, jitter_ms double, anchors long"))


def snapped(chunks: DataFrame, notes: DataFrame, priors: DataFrame, keys, rate: int, hop: int) -> DataFrame:
    """(keys, string, frame, sample, status, strength): attacks of notes under their track's prior (keys, shift_ms, jitter_ms)."""

    def run(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        listed = _notes(b)
        prior = K.Prior(float(b["shift_ms"].iloc[0]), float(b["jitter_ms"].iloc[0]), 0) if len(b) else None
        found = K.snap_notes(_audio(a), rate, hop, listed, prior) if listed else []
        rows = [(*key, n.string, n.frame, s.sample, s.status, s.strength) for n, s in zip(listed, found, strict=True)]
        out = pd.DataFrame(rows, columns=[*keys, "string", "frame", "sample", "status", "strength"])
        return out.astype({"sample": "Int64", "strength": "float64"})

    with_prior = notes.join(priors.select(*keys, "shift_ms", "jitter_ms"), list(keys))
    grouped = chunks.select(*keys, "chunk", "samples").groupBy(*keys).cogroup(with_prior.select(*keys, "string", "frame", "f0", "shift_ms", "jitter_ms").groupBy(*keys))
    return grouped.applyInPandas(run, _schema(chunks, keys, "string int, frame long, sample long, status string, strength double"))


def block_levels(df: DataFrame, array: str, block: int, step: int, out: str = "levels") -> DataFrame:
    """Energy in dB of the differenced array, block by block; array functions alone."""
    a = F.transform(F.col(array), lambda x: x.cast("double"))
    steps = F.transform(a, lambda x, i: F.when(i == 0, F.lit(0.0)).otherwise(x - F.element_at(a, i)))
    count = F.floor((F.size(array) - block) / step).cast("int")
    energy = lambda k: F.aggregate(F.slice(steps, k * step + 1, F.lit(block)), F.lit(0.0), lambda s, x: s + x * x)
    return df.withColumn(out, F.transform(F.sequence(F.lit(0), count), lambda k: 10.0 * F.log10(energy(k) + 1e-12)))


def level_peaks(array, height: float):
    """Places of local maxima of at least ``height`` in an array column; the middle (rounded down) of a level top, none at the ends. Array functions alone."""
    x = F.transform(F.col(array) if isinstance(array, str) else array, lambda v: v.cast("double"))
    first = F.struct(F.try_element_at(x, F.lit(1)).alias("last"), F.lit(0).alias("start"), F.lit(False).alias("risen"), F.lit(0).alias("at"), F.array().cast("array<int>").alias("found"))

    def step(s, v):
        top = s.risen & (v < s.last) & (s.last >= height)
        middle = F.floor((s.start + s.at - 1) / 2).cast("int")
        return F.struct(
            v.alias("last"),
            F.when(v == s.last, s.start).otherwise(s.at).alias("start"),
            F.when(v == s.last, s.risen).otherwise(v > s.last).alias("risen"),
            (s.at + 1).alias("at"),
            F.when(top, F.concat(s.found, F.array(middle))).otherwise(s.found).alias("found"),
        )

    return F.aggregate(x, first, step, lambda s: s.found)

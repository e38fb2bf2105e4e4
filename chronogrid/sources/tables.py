"""Catalogues, annotations and audio as tables with fixed schemas."""

from __future__ import annotations

import io
import struct
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .files import parsed

_JAMS = "annotations array<struct<namespace:string, data:array<struct<time:double, duration:double, confidence:double, value:struct<index:int, frequency:double, voiced:boolean>>>>>"


def jams_observations(files: DataFrame) -> DataFrame:
    """(stem, string, idx, time, frequency, note_id): sounding observations of pitch contours, the n-th contour being string n.

    Parsed by Spark's own JSON reader; unvoiced ones and those at 0 Hz are left out, a
    note without index is note 0.
    """
    doc = files.select("stem", F.from_json(F.col("content").cast("string"), _JAMS).alias("j"))
    contours = F.filter("j.annotations", lambda a: a.namespace == "pitch_contour")
    strings = doc.select("stem", F.posexplode(contours).alias("string", "a"))
    rows = strings.select("stem", "string", F.posexplode("a.data").alias("idx", "o"))
    sounding = F.col("o.value.voiced") & (F.col("o.value.frequency") != 0)
    return rows.where(sounding).select("stem", "string", F.col("idx").cast("long").alias("idx"), "o.time", "o.value.frequency", F.coalesce("o.value.index", F.lit(0)).alias("note_id"))


def json_problems(files: DataFrame) -> DataFrame:
    """(stem, reason) of files that are no JSON; readers of JSON give no rows for these."""
    return files.where(F.try_parse_json(F.col("content").cast("string")).isNull()).select("stem", F.lit("not JSON").alias("reason"))


def jams_problems(files: DataFrame) -> DataFrame:
    """(stem, reason) of JAMS files that are no JSON or hold no pitch contour."""
    doc = files.select("stem", "content", F.from_json(F.col("content").cast("string"), _JAMS).alias("j"))
    contours = F.coalesce(F.size(F.filter("j.annotations", lambda a: a.namespace == "pitch_contour")), F.lit(0))
    none = doc.where(F.try_parse_json(F.col("content").cast("string")).isNotNull() & (contours <= 0)).select("stem", F.lit("no pitch contour").alias("reason"))
    return json_problems(files).unionByName(none)


def sync_points(files: DataFrame) -> DataFrame:
    """(stem, idx, measure, seconds, offset): points [measure, seconds] or [measure, seconds, offset]; shorter ones are left out."""
    points = files.select("stem", F.posexplode(F.from_json(F.col("content").cast("string"), "array<array<double>>")).alias("idx", "p")).where(F.size("p") >= 2)
    return points.select("stem", F.col("idx").cast("long").alias("idx"), F.col("p")[0].alias("measure"), F.col("p")[1].alias("seconds"), F.try_element_at("p", F.lit(3)).alias("offset"))


def metadata(spark: SparkSession, path: str, columns: list[str], assigned: str | None = None) -> DataFrame:
    """CSV with a header as strings, the named columns alone; with ``assigned`` rows where that column is not blank."""
    df = spark.read.option("header", "true").csv(path)
    out = df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])
    return out if assigned is None else out.where(F.coalesce(F.trim(assigned), F.lit("")) != "")


def splits(files: DataFrame) -> DataFrame:
    """(dataset, split, place, stem) of split files {split: [stems]}, the file's name being the dataset's."""
    lists = files.select(F.col("stem").alias("dataset"), F.explode(F.from_json(F.col("content").cast("string"), "map<string, array<string>>")).alias("split", "stems"))
    return lists.select("dataset", "split", F.posexplode("stems").alias("place", "stem"))


def write_splits(split: DataFrame, path: str) -> None:
    """One JSON line a dataset and split, with its stems in order."""
    split.groupBy("dataset", "split").agg(F.sort_array(F.collect_list("stem")).alias("stems")).write.mode("overwrite").json(path)


def write_frames(frames: DataFrame, path: str) -> None:
    """Frames as Parquet, a folder for each dataset; only the datasets written are replaced."""
    frames.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dataset").parquet(path)


def resolved(value, prefix: str) -> Column:
    """A path of a catalogue without its prefix; null if blank."""
    v = F.col(value) if isinstance(value, str) else value
    return F.regexp_replace(F.nullif(F.trim(v), F.lit("")), f"^{prefix}", "")


def existing(df: DataFrame, column: str, files: DataFrame, root: str = "/") -> DataFrame:
    """``column``, a path under ``root``, as the path of the file there; null if blank or if there is no such file."""
    listed = files.select("path", F.regexp_extract("path", f"{root.rstrip('/')}/(.+)$", 1).alias("__under")).where("__under <> ''")
    joined = df.withColumn("__under", F.nullif(F.trim(F.col(column)), F.lit(""))).join(listed.select(F.col("path").alias("__path"), "__under"), "__under", "left")
    return joined.withColumn(column, F.col("__path")).select(*df.columns)


def takes(files: DataFrame, exclude=()) -> DataFrame:
    """(stem, audio, notes): audio and MIDI files that share a stem, the excluded ones left out; a file without its like is left out."""
    kind = F.lower(F.regexp_extract("path", r"\.([^.]+)$", 1))
    listed = files.select("stem", "path", kind.alias("kind")).where(~F.col("stem").isin(*exclude) if exclude else F.lit(True))
    audio = listed.where("kind = 'wav'").select("stem", F.col("path").alias("audio"))
    return audio.join(listed.where("kind IN ('mid', 'midi')").select("stem", F.col("path").alias("notes")), "stem")


@dataclass(frozen=True)
class Naming:
    """How a take's two files are named: patterns of their paths with a group for the session (may be empty) and one for the take."""

    audio: str
    notes: str


def session_naming(folder: str, prefix: str, suffix: str) -> Naming:
    """Sessions P...; audio as PREFIX_TAKE in a folder of the session, notes as midi_TAKE.mid in its folder midi."""
    return Naming(rf"/(P[^/]*)/{folder}/{prefix}_([^/]+)\{suffix}$", r"/(P[^/]*)/midi/midi_([^/]+)\.mid$")


#: Where the recordings of a take lie, and how an annotation's audio is named.
NAMINGS = {
    "directinput": session_naming("audio/directinput", "directinput", ".wav"),
    "micamp": session_naming("audio/micamp", "micamp", ".wav"),
    "ego": session_naming("video/ego", "ego", ".mp3"),
    "exo": session_naming("video/exo", "exo", ".mp3"),
    "mic": Naming(r"/()([^/]+)_mic\.wav$", r"/()([^/]+)\.jams$"),
    "mix": Naming(r"/()([^/]+)_mix\.wav$", r"/()([^/]+)\.jams$"),
}


def _named(files: DataFrame, pattern: str, path: str, exclude) -> DataFrame:
    session, take = F.regexp_extract("path", pattern, 1), F.regexp_extract("path", pattern, 2)
    found = files.where(F.regexp_like("path", F.lit(pattern))).select(F.when(session == "", take).otherwise(F.concat_ws("_", session, take)).alias("stem"), take.alias("__take"), F.col("path").alias(path))
    return found.where(~F.col("__take").isin(*exclude) if exclude else F.lit(True)).drop("__take")


def paired(files: DataFrame, naming: Naming, exclude=()) -> tuple[DataFrame, DataFrame]:
    """((stem, audio, notes) of takes with both files, (stem, reason) of audio without notes); takes in ``exclude`` are in neither.

    ``naming`` is one of NAMINGS or another; a stem is session_take, or the take where
    there are no sessions.
    """
    audio, notes = _named(files, naming.audio, "audio", exclude), _named(files, naming.notes, "notes", exclude)
    return audio.join(notes, "stem"), audio.join(notes.select("stem").distinct(), "stem", "left_anti").select("stem", F.lit("no notes").alias("reason"))


def missing_parts(files: DataFrame, needed=("audio", "pitch", "voiced"), optional=("onset",)) -> DataFrame:
    """(stem, missing, has_<optional>...) of cached tracks, files named STEM-PART.npy: the needed parts that are not there, in order, null if all are."""
    pattern = rf"/([^/]+)-({'|'.join([*needed, *optional])})\.npy$"
    parts = files.where(F.regexp_like("path", F.lit(pattern))).select(F.regexp_extract("path", pattern, 1).alias("stem"), F.regexp_extract("path", pattern, 2).alias("part"))
    have = parts.groupBy("stem").agg(F.collect_set("part").alias("have"))
    lacks = F.concat_ws(", ", F.filter(F.array(*[F.lit(n) for n in needed]), lambda n: ~F.array_contains("have", n)))
    return have.select("stem", F.nullif(lacks, F.lit("")).alias("missing"), *[F.array_contains("have", o).alias(f"has_{o}") for o in optional])


def resample_audio(x: np.ndarray, rate: int, to: int) -> np.ndarray:
    """Band-limited resampling through the spectrum."""
    if rate == to or not len(x):
        return x
    n = int(np.ceil(len(x) * to / rate))
    spectrum = np.fft.rfft(x)
    keep = np.zeros(n // 2 + 1, complex)
    m = min(len(keep), len(spectrum))
    keep[:m] = spectrum[:m]
    return np.fft.irfft(keep, n) * (n / len(x))


#: Fixed values of RIFF wave files: sample formats.
_PCM, _FLOAT, _EXTENSIBLE = 1, 3, 0xFFFE


def _riff(content: bytes) -> tuple[int, int, int, int, bytes]:
    """(format, channels, rate, bits, samples) of a wave file."""
    if content[:4] != b"RIFF" or content[8:12] != b"WAVE":
        raise ValueError("not a wave file")
    at, kind, data = 12, None, None
    while at + 8 <= len(content):
        name, size = content[at : at + 4], int.from_bytes(content[at + 4 : at + 8], "little")
        body = content[at + 8 : at + 8 + size]
        if name == b"fmt " and len(body) >= 16:
            form, channels, rate, _, _, bits = struct.unpack("<HHIIHH", body[:16])
            kind = (int.from_bytes(body[24:26], "little") if form == _EXTENSIBLE and len(body) >= 26 else form, channels, rate, bits)
        elif name == b"data":
            data = body
        at += 8 + size + size % 2
    if kind is None or data is None or not kind[1] or not kind[2]:
        raise ValueError("not a wave file: no format or no samples")
    return *kind, data


def decode_wav(content: bytes, to: int) -> np.ndarray:
    """One channel (the mean) of a wave file of whole numbers (8 to 32 bits) or floats (32, 64) at rate ``to``; ValueError if it can't be read."""
    form, channels, rate, bits, raw = _riff(content)
    frame = channels * max(1, bits // 8)
    raw = raw[: len(raw) // frame * frame]
    if form == _FLOAT and bits in (32, 64):
        x = np.frombuffer(raw, f"<f{bits // 8}").astype(np.float64)
    elif form != _PCM or bits not in (8, 16, 24, 32):
        raise ValueError(f"samples of format {form} with {bits} bits are not read")
    elif bits == 8:
        x = np.frombuffer(raw, np.uint8).astype(np.float64) / 128 - 1
    elif bits == 24:
        x = (np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32) << np.array([8, 16, 24])).sum(axis=1, dtype=np.int32) / 2.0**31
    else:
        x = np.frombuffer(raw, f"<i{bits // 8}").astype(np.float64) / 2.0 ** (bits - 1)
    return resample_audio(x.reshape(-1, channels).mean(axis=1), rate, to).astype(np.float32)


def audio_chunks(files: DataFrame, rate: int, hop: int = 256, frames: int = 4096) -> DataFrame:
    """(stem, reason, chunk, samples): audio at ``rate`` in chunks of whole frames; samples past the last whole frame are left out."""

    def parse(content: bytes) -> list[tuple]:
        x = decode_wav(content, rate)
        x = x[: len(x) // hop * hop]
        size = hop * frames
        return [(k // size, x[k : k + size].tolist()) for k in range(0, len(x), size)]

    return parsed(files, parse, "chunk long, samples array<float>")


def npy_arrays(files: DataFrame) -> DataFrame:
    """(stem, reason, row, values): rows of saved arrays of one or two dimensions, as doubles."""

    def parse(content: bytes) -> list[tuple]:
        x = np.atleast_2d(np.load(io.BytesIO(content), allow_pickle=False))
        return [(k, row.astype(float).tolist()) for k, row in enumerate(x)]

    return parsed(files, parse, "row int, values array<double>")

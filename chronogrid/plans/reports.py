"""Summaries of measured and corrected timing, and guards of label tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from ..functions.scalars import half_even
from ..operators import aggregates as A


def prior_summary(priors: DataFrame, rate: int, hop: int) -> DataFrame:
    """One row: tracks measured, p10, p50 and p90 of their shifts (ms), and the whole number of frames the median suggests."""
    row = A.percentiles(priors.where("anchors > 0"), [], "shift_ms", {"p10": 0.1, "p50": 0.5, "p90": 0.9})
    measured = priors.agg(F.count_if(F.col("anchors") > 0).alias("measured"), F.count("*").alias("tracks"))
    return measured.crossJoin(row).withColumn("suggested_frames", half_even(F.col("p50") / (1000 * hop / rate)))


def moves_summary(shifts: DataFrame) -> DataFrame:
    """(by, n, share): how many tracks moved by how many frames."""
    return A.value_counts(shifts, [], "by")


def status_summary(snaps: DataFrame) -> DataFrame:
    """(status, n, share) of notes."""
    return A.value_counts(snaps, [], "status")


def action_counts(notes: DataFrame) -> DataFrame:
    """(action, n) of note tails, with a row for each action."""
    from ..operators.notes import ACTIONS

    listed = notes.sparkSession.createDataFrame([(a,) for a in ACTIONS], "action string")
    return A.zero_filled(notes.groupBy("action").agg(F.count("*").alias("n")), listed, "action")


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException:
        return False
    return True


def write_corrected(frames: DataFrame, record: dict, source: str, target: str, force: bool = False) -> None:
    """Write corrected frames and how they were made (one row beside them).

    Refused where source and target are one, where the source was itself corrected
    (unless ``force``), and where the target is not empty.
    """
    spark = frames.sparkSession
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("source and target are the same")
    if exists(spark, f"{source}/record") and not force:
        raise ValueError(f"{source} was corrected before")
    if exists(spark, f"{target}/frames"):
        raise ValueError(f"{target} is not empty")
    frames.write.parquet(f"{target}/frames")
    kinds = ", ".join(f"{k} {'long' if isinstance(v, int) else 'string'}" for k, v in record.items())
    spark.createDataFrame([tuple(record.values())], kinds).write.parquet(f"{target}/record")


def write_manifest(report: DataFrame, parameters: dict, path: str) -> None:
    """How a table was made: ``tracks``, a row for each track with its status and reason, and ``parameters``, a row for each setting.

    ``report`` has stem and reason (null: included), and more columns as it likes.
    """
    report.withColumn("status", F.when(F.col("reason").isNull(), "included").otherwise("excluded")).write.mode("overwrite").parquet(f"{path}/tracks")
    rows = [(k, None if v is None else str(v)) for k, v in sorted(parameters.items())]
    report.sparkSession.createDataFrame(rows, "name string, value string").coalesce(1).write.mode("overwrite").parquet(f"{path}/parameters")


def manifest_counts(spark: SparkSession, path: str) -> DataFrame:
    """(status, reason, n) of a written manifest."""
    return spark.read.parquet(f"{path}/tracks").groupBy("status", "reason").agg(F.count("*").alias("n"))


def carry_over(spark: SparkSession, source: str, target: str, names, replaced=("frames", "record")) -> list[str]:
    """Tables of ``source`` that a corrected ``target`` does not replace are its own as well: no bytes are copied, their places are noted in ``carried``."""
    kept = [n for n in names if n not in replaced and exists(spark, f"{source}/{n}")]
    spark.createDataFrame([(n, located(spark, source, n)) for n in kept], "name string, path string").coalesce(1).write.mode("overwrite").parquet(f"{target}/carried")
    return kept


def located(spark: SparkSession, folder: str, name: str) -> str:
    """Path of a table of a label folder, its own or a carried one; ValueError if it has none."""
    if exists(spark, f"{folder}/{name}"):
        return f"{folder}/{name}"
    if exists(spark, f"{folder}/carried"):
        for r in spark.read.parquet(f"{folder}/carried").where(F.col("name") == name).limit(1).collect():
            return r["path"]
    raise ValueError(f"{folder} has no table {name}")


def frame_window(start: float, duration: float, hop_seconds: float, n_frames: int) -> tuple[int, int]:
    """First frame and the one after the last of a stretch of seconds, cut to whole frames; ValueError if it is empty."""
    first, last = max(0, int(start / hop_seconds)), min(n_frames, int((start + duration) / hop_seconds))
    if first >= last:
        raise ValueError(f"window {start}-{start + duration}s is empty; the track has {n_frames * hop_seconds:.1f}s")
    return first, last


def plot_slice(frames: DataFrame, stem: str, window: tuple[int, int], hop_seconds: float) -> DataFrame:
    """(string, frame, seconds, pitch, onset_pitch) of a track's frames in a window: pitch is null where nothing sounds, onset_pitch where no note begins."""
    here = frames.where((F.col("stem") == stem) & (F.col("frame") >= window[0]) & (F.col("frame") < window[1]))
    onset = F.when(F.col("onset"), F.col("pitch")) if "onset" in frames.columns else F.lit(None).cast("double")
    return here.select("string", "frame", (F.col("frame") * hop_seconds).alias("seconds"), F.when(F.col("voiced"), F.col("pitch")).alias("pitch"), onset.alias("onset_pitch"))

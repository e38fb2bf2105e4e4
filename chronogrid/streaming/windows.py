"""Incremental forms of the operators that need no look-ahead; an extension beyond the batch engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def tumbling(events: DataFrame, time: str, width: str, late: str, keys=()) -> DataFrame:
    """Counts and greatest value in windows of fixed width; rows later than ``late`` are left out."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), *keys).agg(F.count("*").alias("n"), F.max("value").alias("max_value")).select(*keys, F.col("window.start").alias("start"), "n", "max_value")


def clusters(events: DataFrame, time: str, gap: str, late: str, keys=()) -> DataFrame:
    """Chained clusters: a cluster closes ``gap`` after its last row."""
    return events.withWatermark(time, late).groupBy(F.session_window(time, gap), *keys).agg(F.count("*").alias("n"), F.max("value").alias("max_value")).select(*keys, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n", "max_value")


def any_sounding(frames: DataFrame, time: str, late: str, keys=("stem", "frame")) -> DataFrame:
    """Whether any string sounds in a frame."""
    return frames.withWatermark(time, late).groupBy(F.window(time, "1 second"), *keys).agg(F.max("voiced").alias("any_voiced")).drop("window")

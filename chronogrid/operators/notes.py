"""Shape of single notes: closing pitch drops, overhangs, note ends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import sounding_cents

#: Fixed values, in cents and milliseconds.
DROP_CENTS, DECAY_MS, GESTURE_MS, SETTLED_CENTS = 25.0, 60.0, 100.0, 15.0
ACTIONS = ("none", "flattened", "preserved", "ambiguous-flattened")


def shaped(frames: DataFrame, keys, frame: str, pitch: str, hop_ms: float, threshold: float = DROP_CENTS, settled: float = SETTLED_CENTS) -> DataFrame:
    """Frames with ``back`` (their place from the note's end), and of their note (keys): run, value, spread, action.

    The closing drop is looked for twice: below the note's median, then below the median
    of what the first search left. ``value`` is the median of the last five sounding
    frames before the drop, or the note's where there are none; ``spread`` is that of the
    last three cents of the drop. All are windows over one partitioning and one sort, so
    the frames are shuffled once.
    """
    note, by_end = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy(F.col(frame).desc())
    sounds = F.col("__p") > 0

    def median(where) -> Column:
        return F.percentile(F.when(where & sounds, F.col("__p")), F.lit(0.5)).over(note)

    def run_below(reference: str) -> Column:
        fell = F.coalesce(sounding_cents("__p", reference) < -threshold, F.lit(False))
        return F.coalesce(F.min(F.when(~fell, F.col("back"))).over(note) - 1, F.max("back").over(note)).cast("long")

    df = frames.withColumn("__p", F.col(pitch).cast("double")).withColumn("back", F.row_number().over(by_end))
    df = df.withColumn("__all", median(F.lit(True))).withColumn("__run", run_below("__all"))
    df = df.withColumn("__left", median(F.col("back") > F.col("__run"))).withColumn("__again", run_below("__left"))
    df = df.withColumn("run", F.when(F.col("__all").isNull(), 0).when(F.col("__left").isNull(), F.col("__run")).otherwise(F.col("__again")).cast("long"))
    before = (F.col("back") > F.col("run")) & sounds
    df = df.withColumn("__n", F.sum(before.cast("int")).over(by_end.rowsBetween(Window.unboundedPreceding, 0)))
    df = df.withColumn("value", F.coalesce(median(before & (F.col("__n") <= 5)), "__all", F.lit(0.0)))
    last = F.when((F.col("back") <= 3) & (F.col("run") >= 3), sounding_cents("__p", "value"))
    df = df.withColumn("__c", last).withColumn("spread", F.max("__c").over(note) - F.min("__c").over(note))
    ms = F.col("run") * F.lit(hop_ms)
    action = F.when(ms <= 0, "none").when(ms < DECAY_MS, "flattened").when((ms >= GESTURE_MS) & F.coalesce(F.col("spread") < settled, F.lit(False)), "preserved").otherwise("ambiguous-flattened")
    return df.withColumn("action", action).drop("__p", "__all", "__run", "__left", "__again", "__n", "__c")


def tails(frames: DataFrame, keys, frame: str, pitch: str, hop_ms: float, threshold: float = DROP_CENTS, settled: float = SETTLED_CENTS) -> DataFrame:
    """Per note (keys): run, value, spread, action of its closing drop, as ``shaped`` finds them."""
    return shaped(frames, keys, frame, pitch, hop_ms, threshold, settled).where("back = 1").select(*keys, "run", "value", "spread", "action")


def flatten(frames: DataFrame, keys, frame: str, pitch: str, hop_ms: float, threshold: float = DROP_CENTS, settled: float = SETTLED_CENTS) -> DataFrame:
    """Frames with the drops of flattened notes held at the note's value; voicing is not touched."""
    out = shaped(frames, keys, frame, pitch, hop_ms, threshold, settled)
    drops = F.col("action").isin("flattened", "ambiguous-flattened") & (F.col("back") <= F.col("run"))
    return out.withColumn(pitch, F.when(drops, F.col("value")).otherwise(F.col(pitch).cast("double"))).select(*frames.columns)


def overhangs(frames: DataFrame, keys, frame: str, pitch: str, divider: int = 5, threshold: float = 15.0) -> DataFrame:
    """Frames with ``silent``: those in a note's last n // divider frames that leave its body's mean by more than ``threshold`` cents.

    The closing part is addressed from the note's first frame on, so a gap in the frames
    moves it. Notes shorter than ``divider`` frames, or with a body that does not sound,
    keep all. One shuffle.
    """
    note = Window.partitionBy(*keys)
    df = frames.withColumn("__n", F.count("*").over(note)).withColumn("__tail", F.min(frame).over(note) + F.col("__n") - F.floor(F.col("__n") / divider))
    df = df.withColumn("__body", F.avg(F.when((F.col(frame) < F.col("__tail")) & (F.col(pitch) > 0), F.col(pitch))).over(note))
    off = (F.col("__n") >= divider) & (F.col(frame) >= F.col("__tail")) & (F.abs(sounding_cents(pitch, "__body")) > threshold)
    return df.withColumn("silent", F.coalesce(off, F.lit(False))).drop("__n", "__tail", "__body")


def note_ends(frames: DataFrame, keys, frame: str = "frame", voiced: str = "voiced", onset: str = "onset") -> DataFrame:
    """(keys, frame, end) of each onset: the first later frame that is unvoiced, missing or an onset."""
    w = Window.partitionBy(*keys).orderBy(frame)
    marked = frames.withColumn("__gap", F.lead(frame).over(w) != F.col(frame) + 1)
    stop = F.when(~F.col(voiced) | F.col(onset), F.col(frame)).when(F.coalesce(F.col("__gap"), F.lit(True)), F.col(frame) + 1)
    ahead = w.rowsBetween(1, Window.unboundedFollowing)
    own = F.when(F.coalesce(F.col("__gap"), F.lit(True)), F.col(frame) + 1)
    return marked.withColumn("end", F.coalesce(own, F.first(stop, ignorenulls=True).over(ahead))).where(F.col(onset)).select(*keys, frame, "end")

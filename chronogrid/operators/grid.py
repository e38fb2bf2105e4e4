"""Operators between events and a regular frame grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import half_even, log2


def note_frames(notes: DataFrame, start: str, end: str, hop: float, n_frames, variant: str = "late") -> DataFrame:
    """first and last frame (half-open) of notes on the grid, halves to the even frame.

    A note has at least one frame. ``variant`` says when a first frame below 0 is
    clipped: ``late`` after that frame is given, ``early`` before; ``n_frames`` (a number
    or column) bounds the last.
    """
    n = F.col(n_frames) if isinstance(n_frames, str) else F.lit(n_frames)
    first, last = half_even(F.col(start) / F.lit(hop)), half_even(F.col(end) / F.lit(hop))
    if variant == "early":
        first = F.greatest(first, F.lit(0))
    last = F.greatest(first + 1, last)
    return notes.withColumn("first", F.greatest(first, F.lit(0))).withColumn("last", F.least(last, n))


def rasterise(notes: DataFrame, keys, order, value: str, onset: Column | None = None) -> DataFrame:
    """Frames (keys, frame, value, onset) that notes with first and last cover; the later note wins a frame.

    A frame is an onset if any note's first frame is there and ``onset`` holds for it,
    whichever note wins the frame. Notes without frames give none. The winner is a
    grouped maximum, combined before the shuffle; no sort of a key's frames is needed.
    """
    marked = notes.withColumn("__onset", F.lit(True) if onset is None else onset).where("first < last")
    frames = marked.withColumn("frame", F.explode(F.sequence("first", F.col("last") - 1)))
    later = F.max(F.struct(*order, F.col(value).alias("__value")))
    starts = F.max((F.col("frame") == F.col("first")) & F.col("__onset"))
    return frames.groupBy(*keys, "frame").agg(later.alias("__w"), starts.alias("onset")).select(*keys, "frame", F.col("__w.__value").alias(value), "onset")


def resample(points: DataFrame, keys, order, time: str, value: str, hop: float, log: bool = True) -> DataFrame:
    """(keys, frame, value): points read at whole multiples of ``hop``, from half a hop before the first to half a hop after the last.

    Between points the value moves in a straight line (of its base-2 logarithm if
    ``log``, which is -inf for a value of 0); outside it stays. A sequence that no multiple
    falls into gives the frame nearest to its first point.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    y = log2(value) if log else F.col(value).cast("double")
    p = points.withColumn("__x0", F.col(time) / F.lit(hop)).withColumn("__y0", y)
    p = p.withColumn("__x1", F.lead("__x0").over(w)).withColumn("__y1", F.lead("__y0").over(w)).withColumn("__first", F.row_number().over(w) == 1)
    low = F.when(F.col("__first"), F.ceil(F.col("__x0") - 0.5)).otherwise(F.ceil("__x0"))
    high = F.when(F.col("__x1").isNull(), F.floor(F.col("__x0") + 0.5)).otherwise(F.ceil("__x1") - 1)
    spans = p.withColumn("__low", low.cast("long")).withColumn("__high", high.cast("long"))
    frames = spans.where("__low <= __high").withColumn("frame", F.explode(F.sequence("__low", "__high")))
    part = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("frame") - F.col("__x0")) / (F.col("__x1") - F.col("__x0"))))
    line = F.when(F.col("__x1").isNull() | (F.col("__x1") == F.col("__x0")), F.col("__y0")).otherwise(F.col("__y0") + (F.col("__y1") - F.col("__y0")) * part)
    met = frames.select(*keys, "frame", line.alias("__y"))
    # Sequences that met no frame.
    ends = spans.groupBy(*keys).agg(F.min(F.when(F.col("__first"), F.struct(half_even("__x0").alias("frame"), F.col("__y0").alias("__y")))).alias("__p"), F.max(F.col("__low") <= F.col("__high")).alias("__met"))
    snapped = ends.where("NOT __met").select(*keys, "__p.frame", "__p.__y")
    out = met.unionByName(snapped)
    return out.select(*keys, "frame", (F.pow(F.lit(2.0), "__y") if log else F.col("__y")).alias(value))


def interpolate(events: DataFrame, anchors: DataFrame, keys, x: str, anchor_x: str, anchor_y: str, anchor_order, out: str = "y") -> DataFrame:
    """Piecewise-linear value at events' x between anchors, kept at the ends' values outside.

    Of anchors at one x the first in ``anchor_order`` counts. Both sides are sorted once
    by key and x, and each event reads the anchors around it. Keys without an anchor give
    null.
    """
    first = F.min(F.struct(*anchor_order, F.col(anchor_y).alias("__y")))
    points = anchors.groupBy(*keys, F.col(anchor_x).cast("double").alias("__x")).agg(first.alias("__s")).select(*keys, "__x", F.col("__s.__y").cast("double").alias("__y"), F.lit(0).alias("__event"))
    both = events.withColumn("__x", F.col(x).cast("double")).withColumn("__event", F.lit(1)).unionByName(points, allowMissingColumns=True)
    px, py = F.when(F.col("__event") == 0, F.col("__x")), F.when(F.col("__event") == 0, F.col("__y"))
    back = Window.partitionBy(*keys).orderBy("__x", "__event").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*keys).orderBy("__x", F.col("__event").desc()).rowsBetween(0, Window.unboundedFollowing)
    both = both.withColumn("__x0", F.last(px, ignorenulls=True).over(back)).withColumn("__y0", F.last(py, ignorenulls=True).over(back))
    both = both.withColumn("__x1", F.first(px, ignorenulls=True).over(ahead)).withColumn("__y1", F.first(py, ignorenulls=True).over(ahead))
    line = F.col("__y0") + (F.col("__y1") - F.col("__y0")) * (F.col("__x") - F.col("__x0")) / (F.col("__x1") - F.col("__x0"))
    value = F.when(F.col("__x0").isNull(), F.col("__y1")).when(F.col("__x1").isNull() | (F.col("__x1") == F.col("__x0")), F.col("__y0")).otherwise(line)
    return both.withColumn(out, value).where("__event = 1").drop("__x", "__y", "__event", "__x0", "__y0", "__x1", "__y1")


def voiced_pool(frames: DataFrame, keys, frame: str = "frame", voiced: str = "voiced") -> DataFrame:
    """Frames in which any string sounds."""
    return frames.groupBy(*keys, frame).agg(F.max(voiced).alias("any_voiced")).where("any_voiced").select(*keys, frame)


def onset_pool(frames: DataFrame, keys, frame: str = "frame", voiced: str = "voiced") -> DataFrame:
    """Frames in which the whole goes from silence to sound."""
    any_ = frames.groupBy(*keys, frame).agg(F.max(voiced).alias("any_voiced"))
    w = Window.partitionBy(*keys).orderBy(frame)
    before = F.lag("any_voiced").over(w) & (F.lag(frame).over(w) == F.col(frame) - 1)
    return any_.withColumn("__before", F.coalesce(before, F.lit(False))).where("any_voiced AND NOT __before").select(*keys, frame)


def tiles(tracks: DataFrame, n_frames: str, width: int, out: str = "start") -> DataFrame:
    """A row for each window start 0, width, 2 width ... of a track, the last one partial; none for empty tracks."""
    return tracks.where(F.col(n_frames) > 0).withColumn(out, F.explode(F.sequence(F.lit(0).cast("long"), F.col(n_frames).cast("long") - 1, F.lit(width).cast("long"))))


def padded(array, start, width: int, pad) -> Column:
    """``width`` elements of an array from the 0-based ``start``, filled up with ``pad`` past its end."""
    a, s = (F.col(array) if isinstance(array, str) else array), (F.col(start) if isinstance(start, str) else start)
    have = F.slice(a, (s + 1).cast("int"), F.lit(width))
    return F.concat(have, F.array_repeat(F.lit(pad), F.lit(width) - F.size(have)))


def item_of(index: DataFrame, tracks: DataFrame, position: str, offset: str, size: str, carry, cell: int = 1 << 16) -> DataFrame:
    """Track (columns ``carry``) and frame of positions in the tracks laid end to end.

    The line of frames is cut into cells; a track has a row in each cell that it reaches
    into. Inside a cell both sides are sorted once, and a position reads the last track
    that begins before it: no range join, and nothing is broadcast. Positions outside
    all tracks are left out; tracks do not overlap.
    """
    start, stop = F.col(offset).cast("long"), (F.col(offset) + F.col(size)).cast("long")
    at = lambda c: F.floor(c / F.lit(cell)).cast("long")
    held = F.struct(start.alias("start"), stop.alias("stop"), *[F.col(c) for c in carry])
    laid = tracks.where(F.col(size) > 0).select(held.alias("__track"), F.explode(F.sequence(at(start), at(stop - 1))).alias("__cell"))
    laid = laid.withColumn("__at", F.col("__track.start"))
    asked = index.withColumn("__at", F.col(position).cast("long")).withColumn("__cell", at(F.col("__at"))).withColumn("__asked", F.lit(1))
    both = asked.unionByName(laid, allowMissingColumns=True)
    w = Window.partitionBy("__cell").orderBy("__at", F.col("__asked").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("__track", F.last("__track", ignorenulls=True).over(w)).where("__asked = 1 AND __at < __track.stop")
    return found.select(*index.columns, *[F.col(f"__track.{c}").alias(c) for c in carry], (F.col("__at") - F.col("__track.start")).alias("frame"))


def translate(frames: DataFrame, keys, by: int, n_frames) -> DataFrame:
    """Frames (keys, frame, voiced, onset, ...) moved by a number of frames, what leaves the grid cut.

    A note whose onset leaves the grid before frame 0 while it still sounds there begins
    again at frame 0.
    """
    n = F.col(n_frames) if isinstance(n_frames, str) else F.lit(n_frames)
    moved = frames.withColumn("frame", F.col("frame") + by).where((F.col("frame") >= 0) & (F.col("frame") < n))
    return moved if by >= 0 else moved.withColumn("onset", F.col("onset") | ((F.col("frame") == 0) & F.col("voiced")))

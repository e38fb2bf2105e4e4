"""Operators on ordered sequences: edges, segments, runs, time maps.

Every operator takes the key columns of a sequence and the columns that order it; the
order must be total within a key for results to be unique. Windows are partitioned by
the key, so one key is one sort in one task, streamed and spillable; operators that need
state beyond a window stream sorted partitions through Python in Arrow batches and hold
a constant amount of state for each key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.kernels import within


def _window(keys: Sequence[str], order: Sequence[str | Column]):
    return Window.partitionBy(*keys).orderBy(*order)


def change_onsets(df: DataFrame, keys, order, value: str, out: str = "onset") -> DataFrame:
    """True where a non-null value differs from the row before it, or is the first."""
    w = _window(keys, order)
    before = F.lag(value).over(w)
    return df.withColumn(out, F.col(value).isNotNull() & ~F.col(value).eqNullSafe(before))


def rising_edges(df: DataFrame, keys, order, flag: str, out: str = "edge") -> DataFrame:
    """True where a flag turns from false (or nothing) to true."""
    w = _window(keys, order)
    return df.withColumn(out, F.coalesce(F.col(flag), F.lit(False)) & ~F.coalesce(F.lag(flag).over(w), F.lit(False)))


def _numbered(df: DataFrame, keys, order, starts: Column, out: str) -> DataFrame:
    w = _window(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("__start", starts.cast("int")).withColumn(out, (F.sum("__start").over(w) - 1).cast("long")).drop("__start")


def segments(df: DataFrame, keys, order, time: str, value: str, gap, out: str = "segment") -> DataFrame:
    """Numbers from 0 of stretches in which the value stays and no step is longer than ``gap``."""
    w = _window(keys, order)
    first = F.row_number().over(w) == 1
    starts = first | ~F.col(value).eqNullSafe(F.lag(value).over(w)) | (F.col(time) - F.lag(time).over(w) > gap)
    return _numbered(df, keys, order, F.coalesce(starts, F.lit(False)), out)


def gap_clusters(df: DataFrame, keys, order, time: str, gap, out: str = "cluster") -> DataFrame:
    """Numbers from 0 of chained clusters: a step longer than ``gap`` begins a new one."""
    starts = F.coalesce(F.col(time) - F.lag(time).over(_window(keys, order)) > gap, F.lit(True))
    return _numbered(df, keys, order, starts, out)


def _changes(columns: list[pa.Array]) -> np.ndarray:
    """Rows at which any of the columns differs from the row before; null is a value."""
    out = np.zeros(len(columns[0]) if columns else 0, bool)
    for c in columns:
        codes = c.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        out[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(out)


def _anchors(keys: int, gap: float):
    """Rows (keys..., time, ...) sorted -> the same with the time of their group's first row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = anchor = None
        for batch in batches:
            if not batch.num_rows:
                continue
            time = batch.column(keys).to_numpy(zero_copy_only=False)
            out = np.empty(len(time), time.dtype)
            cuts = [0, *_changes([batch.column(k) for k in range(keys)]).tolist(), len(time)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                mine, at = tuple(batch.column(k)[a].as_py() for k in range(keys)), a
                rising = bool((time[a + 1 : b] >= time[a : b - 1]).all())
                if mine != key:
                    key, anchor = mine, None
                while at < b:
                    if anchor is None or time[at] - anchor > gap:
                        anchor = time[at]
                    if rising:
                        stop = max(at + 1, within(time[:b], at, anchor, gap))
                    else:
                        stop = at + 1
                    out[at:stop] = anchor
                    at = stop
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, batch.column(keys).type)], [*batch.schema.names, "__anchor"])

    return run


def anchored_groups(df: DataFrame, keys, order, time: str, gap, out: str = "anchor") -> DataFrame:
    """Time of the group's first row: a row farther than ``gap`` from it begins a new group.

    Groups do not chain, so each depends on all before it; rows are sorted by key and
    order and streamed with one anchor of state. A gap of zero or less leaves every time
    as it is.
    """
    if gap <= 0:
        return df.withColumn(out, F.col(time))
    keyed = df.select(*keys, time, *[c for c in df.columns if c not in {*keys, time}])
    ranged = keyed.repartition(*keys).sortWithinPartitions(*keys, *order) if keys else keyed.coalesce(1).sortWithinPartitions(*order)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema) + f", __anchor {df.schema[time].dataType.simpleString()}"
    return ranged.mapInArrow(_anchors(len(keys), gap), schema).withColumnRenamed("__anchor", out)


def continuations(df: DataFrame, keys, order, start: str, end: str, gap, out: str = "continues") -> DataFrame:
    """True where a row starts less than ``gap`` after the end of the row before; none where the gap is not positive."""
    if gap <= 0:
        return df.withColumn(out, F.lit(False))
    return df.withColumn(out, F.coalesce(F.col(start) - F.lag(end).over(_window(keys, order)) < gap, F.lit(False)))


def trailing_run(df: DataFrame, keys, order, holds: Column) -> DataFrame:
    """(keys, run): how many rows at a sequence's end all satisfy ``holds`` (null does not)."""
    back = Window.partitionBy(*keys).orderBy(*[F.col(o).desc() if isinstance(o, str) else o for o in order])
    ranked = df.withColumn("__n", F.row_number().over(back)).withColumn("__holds", F.coalesce(holds, F.lit(False)))
    stop = F.min(F.when(~F.col("__holds"), F.col("__n")))
    return ranked.groupBy(*keys).agg((F.coalesce(stop - 1, F.max("__n"))).cast("long").alias("run"))


def carry_forward(df: DataFrame, keys, order, value: str, default=None, out: str | None = None) -> DataFrame:
    """The last non-null value up to each row, ``default`` before the first."""
    w = _window(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(value, ignorenulls=True).over(w)
    return df.withColumn(out or value, last if default is None else F.coalesce(last, F.lit(default)))


def first_ahead(df: DataFrame, keys, order, value: Column, ahead: int, out: str, default=None) -> DataFrame:
    """The first non-null ``value`` from a row to ``ahead - 1`` rows on."""
    w = _window(keys, order).rowsBetween(0, ahead - 1)
    found = F.first(value, ignorenulls=True).over(w)
    return df.withColumn(out, found if default is None else F.coalesce(found, F.lit(default)))


def neighbour_bounds(df: DataFrame, keys, time: str, before, after, margin) -> DataFrame:
    """Search bounds lo and hi around ``time``, kept ``margin`` off the nearest other times of the key.

    Equal times are no neighbours of each other.
    """
    times = df.select(*keys, time).distinct()
    w = _window(keys, [time])
    near = times.withColumn("__below", F.lag(time).over(w)).withColumn("__above", F.lead(time).over(w))
    joined = df.join(near, [*keys, time])
    lo, hi = F.col(time) - before, F.col(time) + after
    return joined.withColumn("lo", F.greatest(lo, F.col("__below") + margin)).withColumn("hi", F.least(hi, F.col("__above") - margin)).drop("__below", "__above")


def lagged_difference(df: DataFrame, keys, order, value: str, lag: int = 1, out: str = "difference") -> DataFrame:
    """Value less the value ``lag`` rows before; null where there is none."""
    return df.withColumn(out, F.col(value) - F.lag(value, lag).over(_window(keys, order)))


def max_plus_scan(df: DataFrame, keys, order, value: str, step: float, out: str = "best") -> DataFrame:
    """Best of all values up to a row, each lowered by ``-step`` for every row since: one line of a gap-penalised alignment."""
    w = _window(keys, order)
    ranked = df.withColumn("__n", F.row_number().over(w) * F.lit(step))
    run = F.max(F.col(value) - F.col("__n")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return ranked.withColumn(out, run + F.col("__n")).drop("__n")


def offsets(df: DataFrame, order, size: str, keys=(), out: str = "offset", bucket: Column | None = None) -> DataFrame:
    """Sum of the sizes of all rows before.

    With ``bucket``, a value that never falls along the order, sums are made in two
    levels: inside each bucket, and over the buckets' totals, of which alone all meet in
    one task. Without keys and bucket it is for small catalogues, whose rows meet in one
    task.
    """
    before = lambda *parts: Window.partitionBy(*parts)
    rows = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    if bucket is None:
        return df.withColumn(out, F.coalesce(F.sum(size).over(rows(before(*keys).orderBy(*order))), F.lit(0)).cast("long"))
    dealt = df.withColumn("__bucket", bucket)
    totals = dealt.groupBy(*keys, "__bucket").agg(F.sum(size).alias("__sum"))
    bases = totals.select(*keys, F.col("__bucket").alias("__of"), F.coalesce(F.sum("__sum").over(rows(before(*keys).orderBy("__bucket"))), F.lit(0)).alias("__base"))
    inside = F.coalesce(F.sum(size).over(rows(before(*keys, "__bucket").orderBy(*order))), F.lit(0))
    held = dealt.withColumn("__inside", inside)
    joined = held.join(bases.select(*[F.col(k).alias(f"__{k}") for k in keys], "__of", "__base"), _same(keys), "left")
    return joined.withColumn(out, (F.col("__base") + F.col("__inside")).cast("long")).drop("__bucket", "__of", "__base", "__inside", *[f"__{k}" for k in keys])


def _same(keys) -> Column:
    on = F.col("__bucket").eqNullSafe(F.col("__of"))
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return on


def tempo_sections(changes: DataFrame, keys, tick: str, bpm: str, ticks_per_beat: int, default_bpm: float = 120.0) -> DataFrame:
    """Sections of constant tempo: keys, tick0, tick1 (null: open), second0, per_tick.

    A change at tick 0 is put in with the default tempo where a key has none; of
    changes at one tick the greatest tempo holds.
    """
    at = changes.groupBy(*keys, tick).agg(F.max(bpm).alias("__bpm"))
    firsts = at.groupBy(*keys).agg(F.min(tick).alias(tick)).where(F.col(tick) > 0).select(*keys, F.lit(0).cast(changes.schema[tick].dataType).alias(tick), F.lit(default_bpm).alias("__bpm"))
    at = at.select(*keys, tick, F.col("__bpm").cast("double").alias("__bpm")).unionByName(firsts)
    w = _window(keys, [tick])
    per = at.withColumn("per_tick", 60.0 / (F.col("__bpm") * ticks_per_beat)).withColumn("tick1", F.lead(tick).over(w))
    length = (F.col("tick1") - F.col(tick)) * F.col("per_tick")
    second0 = F.coalesce(F.sum(length).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return per.withColumn("second0", second0).select(*keys, F.col(tick).alias("tick0"), "tick1", "second0", "per_tick")


def ticks_to_seconds(events: DataFrame, sections: DataFrame, keys, tick: str, out: str = "seconds") -> DataFrame:
    """Seconds of events' ticks by their section. One sort of both sides by key and tick, and no range join."""
    left = events.withColumn("__event", F.lit(1))
    right = sections.select(*keys, F.col("tick0").alias(tick), F.col("tick0").alias("__tick0"), "second0", "per_tick", F.lit(0).alias("__event"))
    both = left.unionByName(right, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(tick, "__event").rowsBetween(Window.unboundedPreceding, 0)
    last = lambda c: F.last(c, ignorenulls=True).over(w)
    value = last("second0") + (F.col(tick) - last("__tick0")) * last("per_tick")
    return both.withColumn(out, value).where("__event = 1").drop("__event", "__tick0", "second0", "per_tick")

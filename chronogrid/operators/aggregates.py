"""Robust summaries, counts and modes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import note_name

#: Bounds of a jitter and fewest anchors of a prior.
JITTER_MS, ANCHORS = (4.0, 30.0), 20


def robust_prior(df: DataFrame, keys, deviation: str, anchors: int = ANCHORS, bounds=JITTER_MS) -> DataFrame:
    """Per key with at least ``anchors`` deviations: their median (shift), and twice the upper quartile of the distances from it, within bounds (jitter)."""
    shift = df.groupBy(*keys).agg(F.median(deviation).alias("shift"), F.count(deviation).alias("anchors")).where(F.col("anchors") >= anchors)
    apart = df.join(shift.select(*keys, "shift"), list(keys)).groupBy(*keys).agg(F.percentile(F.abs(F.col(deviation) - F.col("shift")), F.lit(0.75)).alias("__q"))
    jitter = F.least(F.greatest(2 * F.col("__q"), F.lit(bounds[0])), F.lit(bounds[1]))
    return shift.join(apart, list(keys)).select(*keys, "shift", jitter.alias("jitter"), "anchors")


def pooled_prior(priors: DataFrame) -> DataFrame:
    """One row: medians of the measured priors, with no anchors of its own."""
    return priors.agg(F.median("shift").alias("shift"), F.median("jitter").alias("jitter")).withColumn("anchors", F.lit(0).cast("long"))


def with_pooled(keys_df: DataFrame, priors: DataFrame, keys) -> DataFrame:
    """Every key's prior, the pooled one where it has none; the pooled row is one row and is broadcast."""
    pooled = pooled_prior(priors).select(F.col("shift").alias("__s"), F.col("jitter").alias("__j"))
    joined = keys_df.join(priors, list(keys), "left").crossJoin(F.broadcast(pooled))
    return joined.select(*keys, F.coalesce("shift", "__s").alias("shift"), F.coalesce("jitter", "__j").alias("jitter"), F.coalesce("anchors", F.lit(0)).cast("long").alias("anchors"))


def percentiles(df: DataFrame, keys, value: str, at: dict[str, float]) -> DataFrame:
    """Exact percentiles with straight lines between ranks."""
    return df.groupBy(*keys).agg(*[F.percentile(value, F.lit(p)).alias(name) for name, p in at.items()])


def value_counts(df: DataFrame, keys, value: str) -> DataFrame:
    return df.groupBy(*keys, value).agg(F.count("*").alias("n")).withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))))


def zero_filled(counts: DataFrame, spark_values: DataFrame, value: str) -> DataFrame:
    """Counts with a row for each listed value."""
    return spark_values.join(counts, value, "left").select(value, F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def mode_first_seen(df: DataFrame, keys, value: str, order) -> DataFrame:
    """Per key the most frequent value, of equals the one seen first."""
    seen = df.groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(F.struct(*order)).alias("__first"))
    w = Window.partitionBy(*keys).orderBy(F.col("n").desc(), "__first")
    return seen.withColumn("__r", F.row_number().over(w)).where("__r = 1").select(*keys, value, "n")


def lane_range(df: DataFrame, keys, midi: str, sounds: Column) -> DataFrame:
    """Per key the range of sounding pitches as note names; one name if it is one, ``silent`` if none sounds."""
    low, high = F.min(F.when(sounds, F.col(midi))), F.max(F.when(sounds, F.col(midi)))
    r = df.groupBy(*keys).agg(low.alias("__low"), high.alias("__high"))
    a, b = note_name("__low"), note_name("__high")
    return r.select(*keys, F.when(F.col("__low").isNull(), "silent").when(a == b, a).otherwise(F.concat(a, F.lit("–"), b)).alias("label"))


def coverage(df: DataFrame, keys, flag: str) -> DataFrame:
    """Share of rows for which the flag holds."""
    return df.groupBy(*keys).agg(F.avg(F.col(flag).cast("double")).alias("coverage"), F.count("*").alias("n"))


def totals(df: DataFrame, keys, size: str, per_hour: float) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"), (F.sum(size) / per_hour).alias("hours"))


def complete(parts: DataFrame, keys, kind: str, needed) -> DataFrame:
    """Keys that have all needed kinds."""
    kinds = parts.groupBy(*keys).agg(F.collect_set(F.when(F.col(kind).isin(*needed), F.col(kind))).alias("__kinds"))
    return kinds.where(F.size("__kinds") == len(needed)).select(*keys)

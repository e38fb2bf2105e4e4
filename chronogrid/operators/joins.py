"""Joins that are more than equality: bands, overlaps, fallbacks, histogram shifts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def band_join(left: DataFrame, right: DataFrame, keys, x: str, y: str, width: float, cell: bool = True) -> DataFrame:
    """Pairs of equal keys with abs(x - y) <= width.

    With ``cell`` the axis is cut into cells of the band's width, left rows are met with
    their own cell and the two beside it, and the join is on keys and cell; so a key that
    holds most rows is still spread by time.
    """
    near = F.abs(F.col(x) - F.col(y)) <= width
    if not cell or width <= 0:
        return left.join(right, list(keys)).where(near)
    a = left.withColumn("__cell", F.explode(F.array(*[F.floor(F.col(x) / width) + d for d in (-1, 0, 1)])))
    b = right.withColumn("__cell", F.floor(F.col(y) / width))
    return a.join(b, [*keys, "__cell"]).where(near).drop("__cell")


def overlap_join(left: DataFrame, right: DataFrame, keys, start: str, end: str, other_start: str, other_end: str, cell: float) -> DataFrame:
    """Pairs of equal keys whose half-open intervals meet; intervals are laid on cells and a pair is kept in its first common one."""
    laid = lambda df, a, b: df.where(F.col(a) < F.col(b)).withColumn("__cell", F.explode(F.sequence(F.floor(F.col(a) / cell), F.floor(F.col(b) / cell))))
    joined = laid(left, start, end).join(laid(right, other_start, other_end), [*keys, "__cell"])
    meet = (F.col(start) < F.col(other_end)) & (F.col(other_start) < F.col(end))
    first = F.floor(F.greatest(F.col(start), F.col(other_start)) / cell) == F.col("__cell")
    return joined.where(meet & first).drop("__cell")


def match_rewards(left: DataFrame, right: DataFrame, keys, x: str, y: str, tolerance: float) -> DataFrame:
    """Band join with reward 1 - distance / tolerance."""
    return band_join(left, right, keys, x, y, tolerance).withColumn("reward", 1.0 - F.abs(F.col(x) - F.col(y)) / tolerance)


def with_fallback(left: DataFrame, first: DataFrame, second: DataFrame, keys, value: str, out: str) -> DataFrame:
    """Left rows with ``value`` of the first table, or of the second where it has none, and which of them it came from."""
    a = first.select(*keys, F.col(value).alias("__a"))
    b = second.select(*keys, F.col(value).alias("__b"))
    source = F.when(F.col("__a").isNotNull(), "first").when(F.col("__b").isNotNull(), "second")
    return left.join(a, keys, "left").join(b, keys, "left").withColumn(out, F.coalesce("__a", "__b")).withColumn("origin", source).drop("__a", "__b")


def missing(wanted: DataFrame, have: DataFrame, keys) -> DataFrame:
    return wanted.join(have.select(*keys).distinct(), keys, "left_anti")


def present(wanted: DataFrame, have: DataFrame, keys) -> DataFrame:
    return wanted.join(have.select(*keys).distinct(), keys, "left_semi")


def first_missing(df: DataFrame, parts: dict[str, DataFrame], keys, out: str = "reason") -> DataFrame:
    """Rows with the name of the first of ``parts`` that lacks their key, null if all have it."""
    reason: Column | None = None
    for name, part in parts.items():
        df = df.join(part.select(*keys).distinct().withColumn(f"__{name}", F.lit(True)), keys, "left")
        lacks = F.col(f"__{name}").isNull()
        reason = F.when(lacks, name) if reason is None else reason.when(lacks, name)
    return df.withColumn(out, reason).drop(*[f"__{n}" for n in parts])


def best_shift(a: DataFrame, b: DataFrame, keys, value: str, most: int, margin: float = 0.25) -> DataFrame:
    """Per key the whole shift of ``a``'s values, within ``most``, whose histogram shares most with ``b``'s.

    The share is of the larger multiset, at least 1. The lowest of equal shifts is taken,
    and 0 unless it beats no shift by more than ``margin``. Histograms are counted before
    shifts are laid out, so work grows with distinct values and not with rows.
    """
    ca = a.groupBy(*keys, F.col(value).alias("__v")).agg(F.count("*").alias("__a"))
    cb = b.groupBy(*keys, F.col(value).alias("__v")).agg(F.count("*").alias("__b"))
    sizes = ca.groupBy(*keys).agg(F.sum("__a").alias("__n")).join(cb.groupBy(*keys).agg(F.sum("__b").alias("__m")), keys, "full")
    total = F.greatest(F.coalesce("__n", F.lit(0)), F.coalesce("__m", F.lit(0)), F.lit(1))
    moved = ca.withColumn("shift", F.explode(F.sequence(F.lit(-most), F.lit(most)))).withColumn("__v", F.col("__v") + F.col("shift"))
    common = moved.join(cb, [*keys, "__v"]).groupBy(*keys, "shift").agg(F.sum(F.least("__a", "__b")).alias("__c"))
    scored = common.join(sizes, keys).withColumn("__s", F.col("__c") / total)
    best = scored.groupBy(*keys).agg(F.max(F.struct("__s", (-F.col("shift")).alias("__k"))).alias("__best"), F.max(F.when(F.col("shift") == 0, F.col("__s"))).alias("__zero"))
    take = F.col("__best.__s") > F.coalesce("__zero", F.lit(0.0)) + margin
    out = best.select(*keys, F.when(take, -F.col("__best.__k")).otherwise(0).cast("long").alias("shift"))
    return sizes.select(*keys).join(out, keys, "left").select(*keys, F.coalesce("shift", F.lit(0)).cast("long").alias("shift"))


def common_counts(a: DataFrame, b: DataFrame, keys, value: str) -> DataFrame:
    """(keys, common): size of the multiset intersection of the two sides' values."""
    ca = a.groupBy(*keys, value).agg(F.count("*").alias("__a"))
    cb = b.groupBy(*keys, value).agg(F.count("*").alias("__b"))
    return ca.join(cb, [*keys, value]).groupBy(*keys).agg(F.sum(F.least("__a", "__b")).alias("common"))

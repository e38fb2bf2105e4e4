"""Leak-free splits, folds, permutations and batches."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from .sequences import offsets


def by_group(df: DataFrame, group: Column, valid: Sequence, test: Sequence) -> DataFrame:
    """``split`` by the group a row is of; a group listed for both is test."""
    return df.withColumn("split", F.when(group.isin(*test), "test").when(group.isin(*valid), "valid").otherwise("train"))


def held_out(df: DataFrame, group: Column, held) -> DataFrame:
    """(…, split): all train, or with a held-out group that one in both valid and test."""
    if held is None:
        return df.withColumn("split", F.lit("train"))
    splits = F.when(group == F.lit(held), F.array(F.lit("valid"), F.lit("test"))).otherwise(F.array(F.lit("train")))
    return df.withColumn("split", F.explode(splits))


def folds(df: DataFrame, group_number: Column, n: int) -> DataFrame:
    """A row for each fold: in fold i group i is test, group i + 1 (round again) valid. A group that is none of 0 to n - 1 ends the job."""
    known = F.coalesce(group_number.between(0, n - 1), F.lit(False))
    number = F.when(known, group_number).otherwise(F.raise_error(F.concat(F.lit("unknown group: "), F.coalesce(group_number.cast("string"), F.lit("null")))).cast("int"))
    f = df.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return f.withColumn("split", F.when(number == F.col("fold"), "test").when(number == F.pmod(F.col("fold") + 1, F.lit(n)), "valid").otherwise("train"))


def hash_order(keys: Sequence[str], seed: int) -> Column:
    """The engine's permutation: md5 of seed and key, which any SQL engine has too."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


#: Hexadecimal digits of a hash that deal a whole catalogue to buckets.
_DIGITS = 3


def permuted(df: DataFrame, key: str, seed: int, epoch: int = 0, within: Sequence[str] = (), out: str = "place") -> DataFrame:
    """Place of each row in the permutation of its group for seed + epoch.

    Without groups, rows are placed inside buckets of the hash first, so that no task
    sees the whole catalogue.
    """
    if within:
        w = Window.partitionBy(*within).orderBy(hash_order([key], seed + epoch), key)
        return df.withColumn(out, (F.row_number().over(w) - 1).cast("long"))
    hashed = df.withColumn("__hash", hash_order([key], seed + epoch)).withColumn("__one", F.lit(1))
    return offsets(hashed, ["__hash", key], "__one", out=out, bucket=F.substring("__hash", 1, _DIGITS)).drop("__hash", "__one")


def random_split(df: DataFrame, key: str, seed: int, share: float = 0.15) -> DataFrame:
    """Test first, then valid, each max(1, int(share * n)) of the permuted catalogue; the rest trains."""
    count = df.agg(F.greatest(F.lit(1), F.floor(F.count("*") * F.lit(share))).alias("__n"))  # one row
    placed = permuted(df, key, seed).crossJoin(F.broadcast(count))
    return placed.withColumn("split", F.when(F.col("place") < F.col("__n"), "test").when(F.col("place") < 2 * F.col("__n"), "valid").otherwise("train")).drop("__n")


def numpy_permutation(keys: Sequence[str], seed: int) -> list[str]:
    """The exact permutation of a sorted catalogue by numpy's generator, on the driver: for parity on small catalogues."""
    ordered = sorted(keys)
    return [ordered[i] for i in np.random.default_rng(seed).permutation(len(ordered))]


def take_until(groups: DataFrame, order, size: str, target, within: Sequence[str] = ()) -> DataFrame:
    """``taken``: groups in order as long as those before have not reached the target."""
    w = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    t = F.col(target) if isinstance(target, str) else F.lit(target)
    return groups.withColumn("taken", F.coalesce(F.sum(size).over(w), F.lit(0)) < t)


def grouped_valid(df: DataFrame, key: str, group: str, seed: int, fraction: float) -> DataFrame:
    """``split``: whole groups in hash order are valid until they hold ``fraction`` of the rows; a row without group is one of its own."""
    own = F.coalesce(F.nullif(F.trim(F.col(group).cast("string")), F.lit("")), F.concat(F.lit("__unknown__"), F.col(key).cast("string")))
    named = df.withColumn("__group", own)
    target = df.agg((F.count("*") * F.lit(fraction)).alias("__target"))  # one row
    sizes = named.groupBy("__group").agg(F.count("*").alias("__n")).withColumn("__hash", hash_order(["__group"], seed))
    before = offsets(sizes, ["__hash", "__group"], "__n", out="__before", bucket=F.substring("__hash", 1, _DIGITS))
    taken = before.crossJoin(F.broadcast(target)).select("__group", (F.col("__before") < F.col("__target")).alias("taken"))
    return named.join(taken, "__group").withColumn("split", F.when(F.col("taken"), "valid").otherwise("train")).drop("__group", "taken")


def mirrored(split: DataFrame, cached: DataFrame, key: str) -> DataFrame:
    """The split's keys that are not cached; a split may be copied if there are none."""
    return split.join(cached.select(key).distinct(), key, "left_anti")


def batches(df: DataFrame, place: str, size: int, within: Sequence[str] = ()) -> DataFrame:
    return df.withColumn("batch", F.floor(F.col(place) / size).cast("long"))

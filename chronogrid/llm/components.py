"""Connected components of a graph whose edges are rows, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import saved


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node each node of ``edges`` can reach.

    Alternating large-star and small-star steps. Each step is a grouped minimum and
    an equi-join; the joins are left to adaptive skew handling, as a star's centre may
    own many edges. The edge list is written to shared storage after each round.
    Null ends and loops are ignored; repeated edges count once; no edges give no rows.
    """
    e = edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).where("u < v").distinct()
    e = saved(e, "edges")
    before = None
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        # Large star: every larger neighbour of a node is linked to the node's smallest.
        large = e.join(low.withColumnRenamed("v", "u"), "u").select("v", F.col("m").alias("u")).where("u < v").distinct()
        # Small star: a node and its smaller neighbours are linked to the smallest of them.
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).unionByName(least.select("v", F.col("m").alias("u")))
        e = saved(small.where("u < v").distinct(), "edges")
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return e.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(e.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())

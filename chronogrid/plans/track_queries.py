"""Track operators on the driver's tables. Greedy and dynamic programmes have no SQL twin; tests hold them against brute force."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import tracks as T
from .sequence_queries import events, table


def _side(spark, d, kind: str):
    e = events(spark, d).where(F.col("event_type") == kind)
    return e.select("user_id", F.col("event_id").alias("idx"), (F.col("t") / F.lit(3.6e9) - 473352).alias("time"), (F.col("event_id") % 4).alias("pitch"))


def monotonic_align(spark, d):
    return T.monotone_align(_side(spark, d, "click"), _side(spark, d, "view"), ["user_id"], 24.0, -0.3, 0.5)


def greedy_assign(spark, d):
    e = events(spark, d)
    notes = e.select("user_id", F.col("event_id").alias("idx"), (F.col("t") / F.lit(1e6)).alias("onset"), (F.col("t") / F.lit(1e6) + F.col("value") * 400).alias("offset"), (F.col("event_id") % 60 + 30).alias("pitch"), F.when(F.col("event_type") == "purchase", (F.col("event_id") % 6).cast("int")).alias("string"))
    tuning = e.select("user_id").distinct().withColumn("s", F.explode(F.array(*[F.struct(F.lit(k).alias("string"), F.lit(p).alias("open")) for k, p in enumerate((40, 45, 50, 55, 59, 64))]))).select("user_id", "s.string", "s.open")
    return T.assign_strings(notes, tuning, ["user_id"])


def transient_levels(spark, d):
    v = T.block_levels(table(spark, d, "embeddings"), "embedding", 32, 8)
    return v.select("vec_id", F.posexplode("levels").alias("block", "level")).select("vec_id", "block", F.round("level", 4).alias("level"))


def transient_peaks(spark, d):
    v = T.block_levels(table(spark, d, "embeddings"), "embedding", 8, 4).withColumn("n", F.size("levels"))
    inner = F.filter(F.transform("levels", lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda s: (s.i > 0) & (s.i < F.size("levels") - 1))
    top = F.filter(inner, lambda s: (s.x > F.element_at("levels", s.i)) & (s.x > F.element_at("levels", s.i + 2)))
    return v.select("vec_id", F.size(top).cast("long").alias("peaks"))


_LEVELS = """l AS (SELECT vec_id, list_transform(range({n}), lambda k: 10 * log10(list_sum(list_transform(range(k * {step} + 1, k * {step} + {block} + 1), lambda i: CASE WHEN i = 1 THEN 0.0::DOUBLE ELSE pow(embedding[i]::DOUBLE - embedding[i - 1]::DOUBLE, 2) END)) + 1e-12::DOUBLE)) AS levels FROM embeddings)"""

QUERIES = {
    "monotonic_align": (monotonic_align, None),
    "greedy_assign": (greedy_assign, None),
    "transient_levels": (transient_levels, f"WITH {_LEVELS.format(n=5, step=8, block=32)} SELECT vec_id, (k - 1)::INT AS block, round(levels[k], 4) AS level FROM (SELECT vec_id, levels, unnest(range(1, 6)) AS k FROM l)"),
    "transient_peaks": (transient_peaks, f"WITH {_LEVELS.format(n=15, step=4, block=8)} SELECT vec_id, len(list_filter(range(2, 15), lambda k: levels[k] > levels[k - 1] AND levels[k] > levels[k + 1]))::BIGINT AS peaks FROM l"),
}

"""Queries over whole tables whose older namesakes have SQL that reads a part of them.

``translate_labels``, ``loader_batches``, ``mirror_check``, ``tempo_sections`` and
``index_to_item`` are held against SQL with cuts that the queries no longer have; that
SQL stays as it is, and so do their differences. Here the same operators are held
against SQL written from what they do.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins as J, splits as P
from . import grid_queries, sequence_queries
from .grid_queries import FRAME_SQL, NOTES
from .sequence_queries import EV, table


def all_neighbours(spark, d):
    n = grid_queries._notes(spark, d)
    side = lambda s, x: n.select("user_id", F.col("event_id").alias(f"{s}_id"), F.col("event_type").alias(f"{s}_type"), F.col("s0").alias(x))
    p = J.band_join(side("a", "x"), side("b", "y"), ["user_id"], "x", "y", 7200.0).where("a_type <> b_type")
    return p.groupBy("a_id").agg(F.count("*").alias("others"), F.min("b_id").alias("least"))


def all_fallbacks(spark, d):
    """Every customer's greatest order, or its balance where it has no order."""
    c = table(spark, d, "customer")
    orders = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("v"))
    return J.with_fallback(c.select("c_custkey"), orders, c.withColumnRenamed("c_acctbal", "v"), ["c_custkey"], "v", "value").select("c_custkey", "value", "origin")


def tracks_not_cached(spark, d):
    """A split's tracks that a mirror lacks: every customer against the users of all events."""
    split = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"))
    return P.mirrored(split, sequence_queries.events(spark, d), "user_id")


QUERIES = {
    "moved_labels": (grid_queries.translate_labels, f"""
WITH {EV}, {FRAME_SQL} SELECT user_id, frame - 3 AS frame, voiced, (onset OR (frame = 3 AND voiced)) AS onset FROM f WHERE frame >= 3"""),
    "batches_of_all_events": (sequence_queries.loader_batches, """
WITH p AS (SELECT event_type, event_id, (row_number() OVER (PARTITION BY event_type ORDER BY md5('2:' || event_id::VARCHAR), event_id) - 1) // 32 AS batch FROM events)
SELECT event_type, batch, count(*) AS n, min(event_id) AS least FROM p GROUP BY ALL"""),
    "tracks_not_cached": (tracks_not_cached, "SELECT c_custkey AS user_id FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)"),
    "tempo_of_every_order": (sequence_queries.tempo_sections, """
WITH o AS (SELECT o_custkey, o_orderkey * 10 AS tick, o_orderkey % 180 + 40 AS bpm FROM orders),
c AS (SELECT o_custkey, tick, max(bpm)::DOUBLE AS bpm FROM o GROUP BY ALL),
a AS (SELECT * FROM c UNION ALL SELECT o_custkey, 0, 120.0 FROM c GROUP BY o_custkey HAVING min(tick) > 0),
p AS (SELECT *, 60.0::DOUBLE / (bpm * 960) AS per, lead(tick) OVER k AS nxt FROM a WINDOW k AS (PARTITION BY o_custkey ORDER BY tick)),
s AS (SELECT *, coalesce(sum((nxt - tick) * per) OVER (PARTITION BY o_custkey ORDER BY tick ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s0 FROM p)
SELECT o.o_custkey, o.tick, round(s.s0 + (o.tick - s.tick) * s.per, 6) AS seconds FROM o ASOF LEFT JOIN s ON o.o_custkey = s.o_custkey AND o.tick >= s.tick"""),
    "positions_to_items": (grid_queries.index_to_item, f"""
WITH {EV}, n AS (SELECT user_id, count(*) AS n FROM e GROUP BY user_id), t AS (SELECT sum(n)::BIGINT AS total FROM n),
o AS (SELECT user_id, n, coalesce(sum(n) OVER (ORDER BY user_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS a FROM n),
p AS (SELECT o_orderkey, o_orderkey % total AS p FROM orders CROSS JOIN t)
SELECT o_orderkey, user_id, p - a AS frame FROM p JOIN o ON p >= a AND p < a + n"""),
    "all_neighbours": (all_neighbours, f"""
WITH {EV}, {NOTES} SELECT a.event_id AS a_id, count(*) AS others, min(b.event_id) AS least FROM n a JOIN n b ON a.user_id = b.user_id AND abs(a.s0 - b.s0) <= 7200 AND a.event_type <> b.event_type GROUP BY a.event_id"""),
    "all_fallbacks": (all_fallbacks, """
WITH o AS (SELECT o_custkey, max(o_totalprice) AS v FROM orders GROUP BY o_custkey)
SELECT c_custkey, coalesce(v, c_acctbal) AS value, CASE WHEN v IS NOT NULL THEN 'first' WHEN c_acctbal IS NOT NULL THEN 'second' END AS origin FROM customer LEFT JOIN o ON o_custkey = c_custkey"""),
}

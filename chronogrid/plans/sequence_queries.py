"""Sequence, split and summary operators on the driver's tables, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import scalars as X
from ..operators import aggregates as A, sequences as S, splits as P

HOUR = 3_600_000_000
#: Common table expression of all SQL twins: events with microseconds.
EV = "e AS (SELECT event_id, user_id, event_type, value, epoch_us(ts) AS t FROM events)"
ORDER = ["t", "event_id"]


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", "user_id", "event_type", "value", X.micros("ts").alias("t"))


def edge_onsets(spark, d):
    e = S.change_onsets(events(spark, d), ["user_id"], ORDER, "event_type")
    e = S.rising_edges(e.withColumn("loud", F.col("value") > 100), ["user_id"], ORDER, "loud")
    return e.select("event_id", "onset", "edge")


def segment_change_or_gap(spark, d):
    e = S.segments(events(spark, d), ["user_id"], ORDER, "t", "event_type", 6 * HOUR)
    return e.groupBy("user_id", "segment").agg(F.min("event_id").alias("first_id"), F.count("*").alias("n"))


def gap_clusters(spark, d):
    e = S.gap_clusters(events(spark, d), ["user_id"], ORDER, "t", 6 * HOUR)
    return e.groupBy("user_id", "cluster").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"), F.round(F.max("value"), 6).alias("max_value"))


def anchored_groups(spark, d):
    return S.anchored_groups(events(spark, d), ["user_id"], ORDER, "t", 12 * HOUR).select("event_id", "anchor")


def _intervals(spark, d):
    return events(spark, d).withColumn("t1", F.col("t") + X.half_even(F.col("value") * 60_000_000))


def continuations(spark, d):
    return S.continuations(_intervals(spark, d), ["user_id"], ORDER, "t", "t1", 2 * HOUR).select("event_id", "continues")


def played_count(spark, d):
    e = S.continuations(_intervals(spark, d), ["user_id"], ORDER, "t", "t1", 2 * HOUR)
    return e.groupBy("user_id").agg(F.count_if(~F.col("continues")).alias("played"), F.count("*").alias("written"))


def trailing_run(spark, d):
    return S.trailing_run(events(spark, d), ["user_id"], ORDER, F.col("value") < 200)


def carry_forward(spark, d):
    e = events(spark, d).withColumn("seen", F.when(F.col("event_type") == "purchase", F.col("event_id")))
    return S.carry_forward(e, ["user_id"], ORDER, "seen", -1).select("event_id", "seen")


def first_ahead(spark, d):
    e = S.first_ahead(events(spark, d), ["user_id"], ORDER, F.when(F.col("value") > 300, F.col("value")), 6, "found", 0.0)
    return e.select("event_id", "found")


def neighbour_bounds(spark, d):
    e = events(spark, d).where("user_id IS NOT NULL")
    return S.neighbour_bounds(e, ["user_id"], "t", 8 * HOUR, 4 * HOUR, HOUR).select("event_id", "lo", "hi")


def lagged_difference(spark, d):
    e = S.lagged_difference(events(spark, d), ["user_id"], ORDER, "t", 3)
    return e.select("event_id", F.coalesce("difference", F.lit(-1)).alias("difference"))


def max_plus_scan(spark, d):
    e = events(spark, d).withColumn("cents", X.half_even(F.col("value") * 100))
    return S.max_plus_scan(e, ["user_id"], ORDER, "cents", -1500.0).select("event_id", F.col("best").cast("long").alias("best"))


def tempo_sections(spark, d):
    o = table(spark, d, "orders").select("o_custkey", (F.col("o_orderkey") * 10).alias("tick"), (F.col("o_orderkey") % 180 + 40).alias("bpm"))
    sections = S.tempo_sections(o, ["o_custkey"], "tick", "bpm", 960)
    return S.ticks_to_seconds(o.select("o_custkey", "tick"), sections, ["o_custkey"], "tick").select("o_custkey", "tick", F.round("seconds", 6).alias("seconds"))


def global_offsets(spark, d):
    n = events(spark, d).groupBy("user_id").agg(F.count("*").alias("n"))
    return S.offsets(n, ["user_id"], "n", bucket=F.floor(F.col("user_id") / 100))


def round_half_even(spark, d):
    e = events(spark, d)
    return e.select("event_id", X.half_even((F.col("event_id") % 1000) / F.lit(2.0)).alias("halves"), X.seconds_to_frame("value", 256 / 22050).alias("frame"), X.ms_to_samples("value", 44100).alias("samples"), X.frame_centre("event_id", 256).alias("centre"))


def pitch_functions(spark, d):
    e = events(spark, d).withColumn("midi", F.col("event_id") % 128)
    hz = X.midi_to_hz("midi")
    return e.select("event_id", X.note_name("midi").alias("name"), F.round(hz, 6).alias("hz"), F.round(X.hz_to_midi("value"), 6).alias("midi_of"), F.round(X.cents("value", hz), 6).alias("cents"), F.round(X.decibels("value"), 6).alias("db"), X.string_index((F.col("midi") % 6) + 1).alias("string"), F.round(X.position("event_id", F.col("midi"), F.col("midi") - 64), 6).alias("position"), X.clip("value", 10.0, 46.0).alias("clipped"))


def text_functions(spark, d):
    c = table(spark, d, "customer").withColumn("odd", F.when(F.col("c_custkey") % 3 == 0, F.lit("  ")).when(F.col("c_custkey") % 3 == 1, F.lit("x1")).otherwise(F.concat(F.col("c_acctbal").cast("decimal(20,2)").cast("string"), F.lit(" "))))
    return c.select("c_custkey", X.sharp_to_word(F.concat(F.lit("A#"), "c_name")).alias("word"), X.blank_to_null("odd").alias("filled"), X.lenient_int("odd").alias("number"))


def hash_permutation(spark, d):
    e = events(spark, d)
    return P.permuted(e, "event_id", 7, 1, ["event_type"]).select("event_id", "place")


def loader_batches(spark, d):
    placed = P.permuted(events(spark, d), "event_id", 0, 2, ["event_type"])
    return P.batches(placed, "place", 32).groupBy("event_type", "batch").agg(F.count("*").alias("n"), F.min("event_id").alias("least"))


def player_split(spark, d):
    o = table(spark, d, "orders").withColumn("player", F.substring(F.lpad(F.col("o_custkey").cast("string"), 8, "0"), 8, 1))
    return P.by_group(o, F.col("player"), ["4"], ["5"]).groupBy("player", "split").agg(F.count("*").alias("n"))


def held_out_split(spark, d):
    c = table(spark, d, "customer")
    return P.held_out(c, F.col("c_mktsegment"), "BUILDING").groupBy("c_mktsegment", "split").agg(F.count("*").alias("n"))


def fold_rotation(spark, d):
    c = table(spark, d, "customer").select("c_custkey", (F.col("c_custkey") % 6).cast("int").alias("player"))
    return P.folds(c, F.col("player"), 6).groupBy("fold", "split").agg(F.count("*").alias("n"), F.sum("c_custkey").alias("keys"))


def random_split(spark, d):
    return P.random_split(table(spark, d, "supplier").select("s_suppkey"), "s_suppkey", 42).select("s_suppkey", "split")


def grouped_valid_split(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 7 != 0, F.concat(F.lit(" g"), (F.col("c_custkey") % 40).cast("string"))).alias("performer"))
    return P.grouped_valid(c, "c_custkey", "performer", 42, 0.1).select("c_custkey", "split")


def take_until_target(spark, d):
    n = events(spark, d).groupBy("event_type", "user_id").agg(F.count("*").alias("n")).withColumn("target", F.lit(200))
    return P.take_until(n, ["user_id"], "n", "target", ["event_type"]).select("event_type", "user_id", "n", "taken")


def mirror_check(spark, d):
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return P.mirrored(customers, table(spark, d, "orders"), "o_custkey")


def robust_prior(spark, d):
    return A.robust_prior(events(spark, d).withColumn("ms", F.col("value") / 10), ["user_id"], "ms").select("user_id", F.round("shift", 6).alias("shift"), F.round("jitter", 6).alias("jitter"), "anchors")


def pooled_prior(spark, d):
    e = events(spark, d).withColumn("ms", F.col("value") / 10)
    keys = e.select("user_id", "event_type").distinct()
    p = A.robust_prior(e, ["user_id", "event_type"], "ms", 15)
    return A.with_pooled(keys, p, ["user_id", "event_type"]).select("user_id", "event_type", F.round("shift", 6).alias("shift"), F.round("jitter", 6).alias("jitter"), "anchors")


def percentile_summary(spark, d):
    p = A.percentiles(events(spark, d), ["event_type"], "value", {"p10": 0.1, "p50": 0.5, "p90": 0.9})
    return p.select("event_type", *[F.round(c, 6).alias(c) for c in ("p10", "p50", "p90")])


def value_counts(spark, d):
    return A.value_counts(events(spark, d), [], "event_type").select("event_type", "n", F.round("share", 6).alias("share"))


def zero_filled_counts(spark, d):
    e = events(spark, d)
    counts = e.where("event_type IN ('view', 'click')").groupBy("event_type").agg(F.count("*").alias("n"))
    return A.zero_filled(counts, e.select("event_type").distinct(), "event_type")


def mode_first_seen(spark, d):
    return A.mode_first_seen(events(spark, d), ["user_id"], "event_type", ORDER)


def lane_range(spark, d):
    e = events(spark, d).withColumn("midi", F.col("event_id") % 60 + 40)
    return A.lane_range(e, ["user_id"], "midi", F.col("value") > 480)


def coverage(spark, d):
    e = A.coverage(events(spark, d).withColumn("hit", F.col("value") > 60), ["user_id"], "hit")
    return e.agg(F.round(F.median("coverage"), 6).alias("median"), F.round(F.avg("coverage"), 6).alias("mean"), F.count("*").alias("tracks"))


def catalogue_totals(spark, d):
    return A.totals(table(spark, d, "documents"), ["lang"], "n_chars", 3600.0).select("lang", "n", F.round("hours", 6).alias("hours"))


def complete_catalogue(spark, d):
    return A.complete(events(spark, d), ["user_id"], "event_type", ["click", "error", "purchase", "signup", "view"])


QUERIES = {
    "edge_onsets": (edge_onsets, f"""
WITH {EV}, w AS (SELECT *, lag(event_type) OVER k AS p, lag(value > 100) OVER k AS l FROM e WINDOW k AS (PARTITION BY user_id ORDER BY t, event_id))
SELECT event_id, (p IS NULL OR p <> event_type) AS onset, (value > 100 AND NOT coalesce(l, false)) AS edge FROM w"""),
    "segment_change_or_gap": (segment_change_or_gap, f"""
WITH {EV}, w AS (SELECT *, CASE WHEN lag(t) OVER k IS NULL OR lag(event_type) OVER k <> event_type OR t - lag(t) OVER k > {6 * HOUR} THEN 1 ELSE 0 END AS s FROM e WINDOW k AS (PARTITION BY user_id ORDER BY t, event_id)),
n AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY t, event_id) - 1 AS segment FROM w)
SELECT user_id, segment::BIGINT AS segment, min(event_id) AS first_id, count(*) AS n FROM n GROUP BY ALL"""),
    "gap_clusters": (gap_clusters, f"""
WITH {EV}, w AS (SELECT *, CASE WHEN lag(t) OVER k IS NULL OR t - lag(t) OVER k > {6 * HOUR} THEN 1 ELSE 0 END AS s FROM e WINDOW k AS (PARTITION BY user_id ORDER BY t, event_id)),
n AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY t, event_id) - 1 AS cluster FROM w)
SELECT user_id, cluster::BIGINT AS cluster, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id, round(max(value), 6) AS max_value FROM n GROUP BY user_id, cluster"""),
    "anchored_groups": (anchored_groups, f"""
WITH RECURSIVE {EV}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS k FROM e),
g AS (SELECT event_id, user_id, k, t AS anchor FROM r WHERE k = 1
  UNION ALL SELECT r.event_id, r.user_id, r.k, CASE WHEN r.t - g.anchor > {12 * HOUR} THEN r.t ELSE g.anchor END FROM g JOIN r ON r.user_id = g.user_id AND r.k = g.k + 1)
SELECT event_id, anchor FROM g"""),
    "continuations": (continuations, f"""
WITH {EV}, w AS (SELECT *, t + round_even(value * 60000000, 0)::BIGINT AS t1 FROM e)
SELECT event_id, coalesce(t - lag(t1) OVER (PARTITION BY user_id ORDER BY t, event_id) < {2 * HOUR}, false) AS continues FROM w"""),
    "played_count": (played_count, f"""
WITH {EV}, w AS (SELECT *, t + round_even(value * 60000000, 0)::BIGINT AS t1 FROM e),
c AS (SELECT user_id, coalesce(t - lag(t1) OVER (PARTITION BY user_id ORDER BY t, event_id) < {2 * HOUR}, false) AS c FROM w)
SELECT user_id, count(*) FILTER (WHERE NOT c) AS played, count(*) AS written FROM c GROUP BY user_id"""),
    "trailing_run": (trailing_run, f"""
WITH {EV}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t DESC, event_id DESC) AS k FROM e)
SELECT user_id, coalesce(min(k) FILTER (WHERE NOT value < 200) - 1, max(k))::BIGINT AS run FROM r GROUP BY user_id"""),
    "carry_forward": (carry_forward, f"""
WITH {EV} SELECT event_id, coalesce(last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), -1) AS seen FROM e"""),
    "first_ahead": (first_ahead, f"""
WITH {EV} SELECT event_id, coalesce(first_value(CASE WHEN value > 300 THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING), 0) AS found FROM e"""),
    "neighbour_bounds": (neighbour_bounds, f"""
WITH {EV}, n AS (SELECT user_id, t, lag(t) OVER k AS below, lead(t) OVER k AS above FROM (SELECT DISTINCT user_id, t FROM e) WINDOW k AS (PARTITION BY user_id ORDER BY t))
SELECT event_id, greatest(t - {8 * HOUR}, coalesce(below + {HOUR}, t - {8 * HOUR})) AS lo, least(t + {4 * HOUR}, coalesce(above - {HOUR}, t + {4 * HOUR})) AS hi FROM e JOIN n USING (user_id, t)"""),
    "lagged_difference": (lagged_difference, f"""
WITH {EV} SELECT event_id, coalesce(t - lag(t, 3) OVER (PARTITION BY user_id ORDER BY t, event_id), -1) AS difference FROM e"""),
    "max_plus_scan": (max_plus_scan, f"""
WITH {EV}, r AS (SELECT *, round_even(value * 100, 0)::BIGINT AS c, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS k FROM e)
SELECT event_id, (max(c + 1500 * k) OVER (PARTITION BY user_id ORDER BY k ROWS UNBOUNDED PRECEDING) - 1500 * k)::BIGINT AS best FROM r"""),
    "tempo_sections": (tempo_sections, """
WITH o AS (SELECT o_custkey, o_orderkey * 10 AS tick, o_orderkey % 180 + 40 AS bpm FROM orders),
c AS (SELECT o_custkey, tick, max(bpm)::DOUBLE AS bpm FROM o WHERE tick % 3 = 0 GROUP BY ALL),
a AS (SELECT * FROM c UNION ALL SELECT o_custkey, 0, 120.0 FROM c GROUP BY o_custkey HAVING min(tick) > 0),
p AS (SELECT *, 60.0 / (bpm * 960) AS per, lead(tick) OVER k AS nxt FROM a WINDOW k AS (PARTITION BY o_custkey ORDER BY tick)),
s AS (SELECT *, coalesce(sum((nxt - tick) * per) OVER (PARTITION BY o_custkey ORDER BY tick ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s0 FROM p)
SELECT o.o_custkey, o.tick, round(s.s0 + (o.tick - s.tick) * s.per, 6) AS seconds FROM o ASOF LEFT JOIN s ON o.o_custkey = s.o_custkey AND o.tick >= s.tick"""),
    "global_offsets": (global_offsets, f"""
WITH {EV}, n AS (SELECT user_id, count(*) AS n FROM e GROUP BY user_id)
SELECT user_id, n, coalesce(sum(n) OVER (ORDER BY user_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset" FROM n"""),
    "round_half_even": (round_half_even, """
SELECT event_id, round_even((event_id % 1000) / 2.0, 0)::BIGINT AS halves, round_even(value / (256.0::DOUBLE / 22050), 0)::BIGINT AS frame, round_even(value / 1000 * 44100, 0)::BIGINT AS samples, ((event_id + 0.5::DOUBLE) * 256) AS centre FROM events"""),
    "pitch_functions": (pitch_functions, """
WITH m AS (SELECT event_id, value, event_id % 128 AS midi, 440.0::DOUBLE * pow(2.0::DOUBLE, (event_id % 128 - 69) / 12.0::DOUBLE) AS hz FROM events)
SELECT event_id, ['C','C#','D','D#','E','F','F#','G','G#','A','A#','B'][(midi % 12 + 1)::INT] || (floor(midi / 12.0)::BIGINT - 1)::VARCHAR AS name, round(hz, 6) AS hz,
  round(69 + 12.0::DOUBLE * log2(value / 440.0::DOUBLE), 6) AS midi_of, round(1200.0::DOUBLE * log2(value / hz), 6) AS cents, round(10.0::DOUBLE * log10(value + 1e-12::DOUBLE), 6) AS db,
  6 - (midi % 6 + 1) AS string, round(event_id + midi / greatest(1, midi - 64)::DOUBLE, 6) AS position, least(greatest(value, 10.0::DOUBLE), 46.0::DOUBLE) AS clipped FROM m"""),
    "text_functions": (text_functions, r"""
WITH c AS (SELECT c_custkey, c_name, CASE c_custkey % 3 WHEN 0 THEN '  ' WHEN 1 THEN 'x1' ELSE c_acctbal::DECIMAL(20,2)::VARCHAR || ' ' END AS odd FROM customer)
SELECT c_custkey, regexp_replace('A#' || c_name, '([A-G])#', '\1sharp', 'g') AS word, nullif(trim(odd), '') AS filled, coalesce(trunc(try_cast(trim(odd) AS DOUBLE))::BIGINT, 0) AS number FROM c"""),
    "hash_permutation": (hash_permutation, """
SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY md5('8:' || event_id::VARCHAR), event_id) - 1 AS place FROM events"""),
    "loader_batches": (loader_batches, """
WITH p AS (SELECT event_type, event_id, (row_number() OVER (PARTITION BY event_type ORDER BY md5('2:' || event_id::VARCHAR), event_id) - 1) // 32 AS batch FROM events WHERE value > 250)
SELECT event_type, batch, count(*) AS n, min(event_id) AS least FROM p GROUP BY ALL"""),
    "player_split": (player_split, """
WITH p AS (SELECT substring(lpad(o_custkey::VARCHAR, 8, '0'), 8, 1) AS player FROM orders)
SELECT player, CASE player WHEN '5' THEN 'test' WHEN '4' THEN 'valid' ELSE 'train' END AS split, count(*) AS n FROM p GROUP BY ALL"""),
    "held_out_split": (held_out_split, """
SELECT c_mktsegment, split, count(*) AS n FROM (SELECT c_mktsegment, unnest(CASE WHEN c_mktsegment = 'BUILDING' THEN ['valid', 'test'] ELSE ['train'] END) AS split FROM customer) GROUP BY ALL"""),
    "fold_rotation": (fold_rotation, """
WITH f AS (SELECT c_custkey, (c_custkey % 6)::INT AS p, unnest(range(6))::INT AS fold FROM customer)
SELECT fold, CASE WHEN p = fold THEN 'test' WHEN p = (fold + 1) % 6 THEN 'valid' ELSE 'train' END AS split, count(*) AS n, sum(c_custkey)::BIGINT AS keys FROM f GROUP BY ALL"""),
    "random_split": (random_split, """
WITH p AS (SELECT s_suppkey, row_number() OVER (ORDER BY md5('42:' || s_suppkey::VARCHAR), s_suppkey) - 1 AS place, greatest(1, floor(count(*) OVER () * 0.15)) AS n FROM supplier)
SELECT s_suppkey, CASE WHEN place < n THEN 'test' WHEN place < 2 * n THEN 'valid' ELSE 'train' END AS split FROM p"""),
    "grouped_valid_split": (grouped_valid_split, """
WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN 'g' || (c_custkey % 40)::VARCHAR ELSE '__unknown__' || c_custkey::VARCHAR END AS g FROM customer),
n AS (SELECT g, count(*) AS n FROM c GROUP BY g),
t AS (SELECT g, coalesce(sum(n) OVER (ORDER BY md5('42:' || g), g ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < sum(n) OVER () * 0.1::DOUBLE AS taken FROM n)
SELECT c_custkey, CASE WHEN taken THEN 'valid' ELSE 'train' END AS split FROM c JOIN t USING (g)"""),
    "take_until_target": (take_until_target, f"""
WITH {EV}, n AS (SELECT event_type, user_id, count(*) AS n FROM e GROUP BY ALL)
SELECT event_type, user_id, n, coalesce(sum(n) OVER (PARTITION BY event_type ORDER BY user_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < 200 AS taken FROM n"""),
    "mirror_check": (mirror_check, """
SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey % 5 = 0 AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 2 = 0)"""),
    "robust_prior": (robust_prior, f"""
WITH {EV}, m AS (SELECT user_id, value / 10 AS ms FROM e), s AS (SELECT user_id, median(ms) AS shift, count(*) AS anchors FROM m GROUP BY user_id HAVING count(*) >= 20)
SELECT user_id, round(any_value(shift), 6) AS shift, round(least(greatest(2 * quantile_cont(abs(ms - shift), 0.75), 4.0::DOUBLE), 30.0::DOUBLE), 6) AS jitter, any_value(anchors) AS anchors FROM m JOIN s USING (user_id) GROUP BY user_id"""),
    "pooled_prior": (pooled_prior, f"""
WITH {EV}, m AS (SELECT user_id, event_type, value / 10 AS ms FROM e), s AS (SELECT user_id, event_type, median(ms) AS shift, count(*) AS anchors FROM m GROUP BY ALL HAVING count(*) >= 15),
p AS (SELECT user_id, event_type, any_value(shift) AS shift, least(greatest(2 * quantile_cont(abs(ms - shift), 0.75), 4.0::DOUBLE), 30.0::DOUBLE) AS jitter, any_value(anchors) AS anchors FROM m JOIN s USING (user_id, event_type) GROUP BY ALL),
d AS (SELECT median(shift) AS ds, median(jitter) AS dj FROM p)
SELECT user_id, event_type, round(coalesce(shift, ds), 6) AS shift, round(coalesce(jitter, dj), 6) AS jitter, coalesce(anchors, 0) AS anchors FROM (SELECT DISTINCT user_id, event_type FROM e) LEFT JOIN p USING (user_id, event_type) CROSS JOIN d"""),
    "percentile_summary": (percentile_summary, """
SELECT event_type, round(quantile_cont(value, 0.1), 6) AS p10, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.9), 6) AS p90 FROM events GROUP BY event_type"""),
    "value_counts": (value_counts, """
SELECT event_type, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM events GROUP BY event_type"""),
    "zero_filled_counts": (zero_filled_counts, """
SELECT event_type, count(*) FILTER (WHERE event_type IN ('view', 'click')) AS n FROM events GROUP BY event_type"""),
    "mode_first_seen": (mode_first_seen, f"""
WITH {EV}, n AS (SELECT user_id, event_type, count(*) AS n, min(event_id) AS f, min(struct_pack(t := t, i := event_id)) AS s FROM e GROUP BY ALL)
SELECT user_id, event_type, n FROM n QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, s) = 1"""),
    "lane_range": (lane_range, """
WITH m AS (SELECT user_id, min(CASE WHEN value > 480 THEN event_id % 60 + 40 END) AS a, max(CASE WHEN value > 480 THEN event_id % 60 + 40 END) AS b FROM events GROUP BY user_id),
n AS (SELECT user_id, ['C','C#','D','D#','E','F','F#','G','G#','A','A#','B'][(a % 12 + 1)::INT] || (a // 12 - 1)::VARCHAR AS x, ['C','C#','D','D#','E','F','F#','G','G#','A','A#','B'][(b % 12 + 1)::INT] || (b // 12 - 1)::VARCHAR AS y FROM m)
SELECT user_id, CASE WHEN x IS NULL THEN 'silent' WHEN x = y THEN x ELSE x || '–' || y END AS label FROM n"""),
    "coverage": (coverage, """
WITH c AS (SELECT user_id, avg((value > 60)::INT::DOUBLE) AS c FROM events GROUP BY user_id)
SELECT round(median(c), 6) AS median, round(avg(c), 6) AS mean, count(*) AS tracks FROM c"""),
    "catalogue_totals": (catalogue_totals, "SELECT lang, count(*) AS n, round(sum(n_chars) / 3600.0::DOUBLE, 6) AS hours FROM documents GROUP BY lang"),
    "complete_catalogue": (complete_catalogue, "SELECT user_id FROM events WHERE event_type IN ('click', 'error', 'purchase', 'signup', 'view') GROUP BY user_id HAVING count(DISTINCT event_type) = 5"),
}

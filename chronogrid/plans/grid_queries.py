"""Grid, note and join operators on the driver's tables, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..operators import grid as G, joins as J, notes as N, sequences as S
from .sequence_queries import EV, events, table


def _notes(spark, d) -> DataFrame:
    """Events as notes of their user: seconds since the first event of all, lasting value * 30 s."""
    e = events(spark, d).withColumn("s0", (F.col("t") - 1_704_067_200_000_000) / F.lit(1e6))
    return e.withColumn("s1", F.col("s0") + F.col("value") * 30).withColumn("midi", (F.col("event_id") % 60 + 40).cast("long"))


NOTES = "n AS (SELECT *, (t - 1704067200000000) / 1e6 AS s0, (t - 1704067200000000) / 1e6 + value * 30 AS s1, event_id % 60 + 40 AS midi FROM e)"
HOP, FRAMES = 1800.0, 1500


def _raster(spark, d, variant, lead):
    n = _earlier(_notes(spark, d), lead)
    n = G.note_frames(n, "s0", "s1", HOP, FRAMES, variant)
    r = G.rasterise(n, ["user_id"], ["event_id"], "midi", F.col("event_type") != "error")
    return r.groupBy("user_id").agg(F.count("*").alias("frames"), F.sum(F.col("midi") * F.col("frame")).alias("weighted"), F.count_if(F.col("onset")).alias("onsets"))


def _earlier(notes, lead):
    return notes.withColumn("s0", F.col("s0") - lead).withColumn("s1", F.col("s1") - lead)


def rasterise_last_wins(spark, d):
    return _raster(spark, d, "late", 0.0)


def rasterise_clip_early(spark, d):
    return _raster(spark, d, "early", 40_000.0)


def _raster_sql(early: bool, lead: float) -> str:
    first = "greatest(f, 0)" if early else "f"
    return f"""
WITH {EV}, {NOTES}, r AS (SELECT *, round_even((s0 - {lead}) / {HOP}::DOUBLE, 0)::BIGINT AS f, round_even((s1 - {lead}) / {HOP}::DOUBLE, 0)::BIGINT AS l FROM n),
b AS (SELECT *, greatest(f, 0) AS a, least(greatest({first} + 1, l), {FRAMES}) AS z FROM r),
x AS (SELECT user_id, event_id, midi, event_type, a, unnest(range(a, z)) AS frame FROM b WHERE a < z),
w AS (SELECT user_id, frame, arg_max(midi, event_id) AS midi, bool_or(frame = a AND event_type <> 'error') AS onset FROM x GROUP BY user_id, frame)
SELECT user_id, count(*) AS frames, sum(midi * frame)::BIGINT AS weighted, count(*) FILTER (WHERE onset) AS onsets FROM w GROUP BY user_id"""


def grid_interpolate(spark, d):
    n = _notes(spark, d)
    g = G.resample(n, ["user_id"], ["s0", "event_id"], "s0", "value", 21600.0)
    return g.select("user_id", "frame", F.round("value", 6).alias("value"))


def interp_clamped(spark, d):
    n = _notes(spark, d)
    anchors = n.where("event_type = 'view'").select("user_id", F.col("s0").alias("ax"), F.col("value").alias("ay"), "event_id")
    out = G.interpolate(n.select("user_id", "event_id", "s0"), anchors, ["user_id"], "s0", "ax", "ay", ["event_id"])
    return out.select("event_id", F.round("y", 6).alias("y"))


def _frames(spark, d) -> DataFrame:
    """Events as frames of strings: string = event type, frame = place among the user's events."""
    e = events(spark, d)
    w = Window.partitionBy("user_id").orderBy("t", "event_id")
    return e.withColumn("frame", (F.row_number().over(w) - 1).cast("long")).withColumn("voiced", F.col("value") > 150).withColumn("onset", (F.col("value") > 150) & (F.col("event_id") % 3 == 0))


FRAME_SQL = "f AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) - 1 AS frame, value > 150 AS voiced, value > 150 AND event_id % 3 = 0 AS onset FROM e)"


def voiced_pool(spark, d):
    f = _frames(spark, d).withColumn("frame", F.floor(F.col("frame") / 2))
    return G.voiced_pool(f, ["user_id"])


def onset_pool(spark, d):
    f = _frames(spark, d).withColumn("frame", F.floor(F.col("frame") / 2))
    return G.onset_pool(f, ["user_id"])


def tile_windows(spark, d):
    tracks = events(spark, d).groupBy("user_id").agg(F.count("*").alias("n"))
    return G.tiles(tracks, "n", 32).select("user_id", "start")


def padded_window(spark, d):
    v = table(spark, d, "embeddings").withColumn("start", (F.col("vec_id") % 64).cast("long"))
    return v.select("vec_id", G.padded("embedding", "start", 16, 0.0).cast("array<double>").alias("w")).select("vec_id", F.size("w").alias("n"), F.round(F.aggregate("w", F.lit(0.0), lambda a, x: a + x), 4).alias("total"), F.element_at("w", 16).alias("last"))


def index_to_item(spark, d):
    tracks = S.offsets(events(spark, d).groupBy("user_id").agg(F.count("*").alias("n")), ["user_id"], "n", bucket=F.floor(F.col("user_id") / 100))
    total = tracks.agg(F.sum("n").alias("total"))
    index = table(spark, d, "orders").join(F.broadcast(total)).select("o_orderkey", (F.col("o_orderkey") % F.col("total")).alias("position"))
    return G.item_of(index, tracks, "position", "offset", "n", ["user_id"]).select("o_orderkey", "user_id", "frame")


def translate_labels(spark, d):
    # A user's grid has as many frames as the user has events.
    f = _frames(spark, d).withColumn("n", F.count("*").over(Window.partitionBy("user_id")))
    moved = G.translate(f.select("user_id", "frame", "voiced", "onset", "n"), ["user_id"], -3, "n")
    return moved.select("user_id", "frame", "voiced", "onset")


def note_ends(spark, d):
    return N.note_ends(_frames(spark, d), ["user_id"]).select("user_id", "frame", F.col("end").cast("long").alias("end"))


def _contours(spark, d) -> DataFrame:
    """Each order's lines as a note: frame = line number, pitch from its price, level with a drop at its end."""
    li = table(spark, d, "lineitem").groupBy("l_orderkey", F.col("l_linenumber").alias("frame")).agg(F.max("l_extendedprice").alias("pitch"))
    near = (220.0 + F.col("pitch") % 3).alias("pitch")
    return li.select("l_orderkey", "frame", F.when((F.col("l_orderkey") % 4 != 0) & (F.col("frame") >= 5 - F.col("l_orderkey") % 3), 210.0 + F.col("pitch") % 2).otherwise(near).alias("pitch"))


CONTOUR_SQL = """li AS (SELECT l_orderkey, l_linenumber AS frame, max(l_extendedprice) AS p FROM lineitem WHERE l_linenumber <= 7 GROUP BY ALL),
c AS (SELECT l_orderkey, frame, CASE WHEN l_orderkey % 4 <> 0 AND frame >= 5 - l_orderkey % 3 THEN 210.0::DOUBLE + p % 2 ELSE 220.0::DOUBLE + p % 3 END AS pitch FROM li)"""
TAILS_SQL = f"""{CONTOUR_SQL},
b AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY frame DESC) AS back FROM c),
r1 AS (SELECT l_orderkey, median(pitch) AS ref FROM b GROUP BY l_orderkey),
d1 AS (SELECT l_orderkey, any_value(ref) AS ref, coalesce(min(back) FILTER (WHERE NOT 1200 * log2(pitch / ref) < -25) - 1, max(back)) AS run FROM b JOIN r1 USING (l_orderkey) GROUP BY l_orderkey),
r2 AS (SELECT l_orderkey, median(pitch) FILTER (WHERE back > run) AS ref2 FROM b JOIN d1 USING (l_orderkey) GROUP BY l_orderkey),
d2 AS (SELECT l_orderkey, any_value(ref2) AS ref2, coalesce(min(back) FILTER (WHERE NOT coalesce(1200 * log2(pitch / ref2) < -25, false)) - 1, max(back)) AS run2 FROM b JOIN r2 USING (l_orderkey) GROUP BY l_orderkey),
k AS (SELECT l_orderkey, ref, CASE WHEN ref2 IS NULL THEN run ELSE run2 END AS run FROM d1 JOIN d2 USING (l_orderkey)),
h AS (SELECT l_orderkey, median(pitch) AS held FROM (SELECT b.*, row_number() OVER (PARTITION BY l_orderkey ORDER BY back) AS q FROM b JOIN k USING (l_orderkey) WHERE back > run) WHERE q <= 5 GROUP BY l_orderkey),
v AS (SELECT l_orderkey, run, coalesce(held, ref, 0) AS value FROM k LEFT JOIN h USING (l_orderkey)),
s AS (SELECT l_orderkey, max(1200 * log2(pitch / value)) - min(1200 * log2(pitch / value)) AS spread FROM b JOIN v USING (l_orderkey) WHERE back <= run AND back <= 3 AND run >= 3 GROUP BY l_orderkey),
z AS (SELECT l_orderkey, run, value, CASE WHEN run <= 0 THEN 'none' WHEN run * 30.0 < 60 THEN 'flattened' WHEN run * 30.0 >= 100 AND coalesce(spread < 15, false) THEN 'preserved' ELSE 'ambiguous-flattened' END AS action FROM v LEFT JOIN s USING (l_orderkey))"""


def tail_classify(spark, d):
    t = N.tails(_contours(spark, d), ["l_orderkey"], "frame", "pitch", 30.0)
    return t.select("l_orderkey", "run", F.round("value", 6).alias("value"), "action")


def tail_flatten(spark, d):
    f = N.flatten(_contours(spark, d), ["l_orderkey"], "frame", "pitch", 30.0)
    return f.select("l_orderkey", "frame", F.round("pitch", 6).alias("pitch"))


def overhang_trim(spark, d):
    o = N.overhangs(_contours(spark, d), ["l_orderkey"], "frame", "pitch")
    return o.select("l_orderkey", "frame", "silent")


def band_join_rewards(spark, d):
    n = _notes(spark, d)
    a = n.where("event_type = 'click'").select("user_id", F.col("event_id").alias("a_id"), F.col("s0").alias("x"))
    b = n.where("event_type = 'view'").select("user_id", F.col("event_id").alias("b_id"), F.col("s0").alias("y"))
    return J.match_rewards(a, b, ["user_id"], "x", "y", 20_000.0).select("a_id", "b_id", F.round("reward", 6).alias("reward"))


def interval_overlap(spark, d):
    n = _notes(spark, d)
    a = n.where("event_type = 'click'").select("user_id", F.col("event_id").alias("a_id"), F.col("s0").alias("a0"), F.col("s1").alias("a1"))
    b = n.where("event_type <> 'click'").select("user_id", F.col("event_id").alias("b_id"), F.col("s0").alias("b0"), F.col("s1").alias("b1"))
    return J.overlap_join(a, b, ["user_id"], "a0", "a1", "b0", "b1", 14_400.0).select("a_id", "b_id")


def neighbours(spark, d):
    n = _notes(spark, d)
    a = n.select("user_id", F.col("event_id").alias("a_id"), F.col("event_type").alias("a_type"), F.col("s0").alias("x"))
    b = n.where("value > 50").select("user_id", F.col("event_id").alias("b_id"), F.col("event_type").alias("b_type"), F.col("s0").alias("y"))
    p = J.band_join(a, b, ["user_id"], "x", "y", 7200.0).where("a_type <> b_type")
    return p.groupBy("a_id").agg(F.count("*").alias("others"), F.min("b_id").alias("least"))


def hist_intersection_shift(spark, d):
    n = _notes(spark, d).withColumn("pitch", F.col("event_id") % 24 + F.col("user_id") % 3 * 12)
    a, b = n.where("event_type = 'click'"), n.where("event_type = 'view'").withColumn("pitch", F.col("event_id") % 24)
    return J.best_shift(a, b, ["user_id"], "pitch", 12, 0.05)


def multiset_intersection(spark, d):
    n = _notes(spark, d)
    return J.common_counts(n.where("event_type = 'click'"), n.where("event_type = 'view'"), ["user_id"], "midi")


def semi_split(spark, d):
    c, o = table(spark, d, "customer"), table(spark, d, "orders").where("o_totalprice > 200000").withColumnRenamed("o_custkey", "c_custkey")
    return J.present(c, o, ["c_custkey"]).select("c_custkey")


def anti_missing(spark, d):
    c, o = table(spark, d, "customer"), table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return J.missing(c, o, ["c_custkey"]).select("c_custkey")


def left_fallback(spark, d):
    docs = table(spark, d, "documents").select("doc_id")
    first = table(spark, d, "labels").where("quality = 1").groupBy("doc_id").agg(F.max("toxic").cast("long").alias("v"))
    second = table(spark, d, "documents").where("n_chars > 1000").select("doc_id", F.col("n_chars").alias("v"))
    return J.with_fallback(docs, first, second, ["doc_id"], "v", "value").select("doc_id", "value", "origin")


def first_missing_part(spark, d):
    c = table(spark, d, "customer").select("c_custkey")
    o = table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    parts = {"open": o.where("o_orderstatus = 'O'"), "filled": o.where("o_orderstatus = 'F'"), "urgent": o.where("o_orderpriority = '1-URGENT'")}
    return J.first_missing(c, parts, ["c_custkey"]).groupBy("reason").agg(F.count("*").alias("n"))


def threshold_gate(spark, d):
    docs, lab = table(spark, d, "documents"), table(spark, d, "labels")
    j = docs.join(lab, "doc_id", "left")
    use = F.when(F.col("quality").isNotNull() & (F.col("quality") >= 0.5), "fine").when(F.col("quality").isNotNull(), "reject").when(F.col("n_chars") > 500, "fallback").otherwise("none")
    return j.select("doc_id", use.alias("use"))


def measure_agreement(spark, d):
    e = table(spark, d, "conversations")
    written = e.groupBy("conv_id").agg((F.max("turn") + 1).alias("expected"))
    played = e.where("role = 'assistant'").groupBy("conv_id").agg((F.max("turn") + 1).alias("performed"))
    j = written.join(played, "conv_id", "left")
    return j.select("conv_id", "expected", F.coalesce("performed", F.lit(0)).alias("performed"), (F.col("performed").isNull() | (F.abs(F.col("performed") - F.col("expected")) <= 1)).alias("agrees"))


def set_operations(spark, d):
    o = table(spark, d, "orders")
    a, b = o.where("o_totalprice > 100000").select("o_custkey"), o.where("o_orderstatus = 'O'").select("o_custkey")
    counted = lambda df, n: df.groupBy().agg(F.count("*").alias("n"), F.sum("o_custkey").alias("keys")).withColumn("what", F.lit(n))
    return counted(a.exceptAll(b), "except").unionByName(counted(a.intersectAll(b), "intersect")).unionByName(counted(a.unionByName(b), "union")).unionByName(counted(a.union(b).distinct(), "distinct"))


def manifest_counts(spark, d):
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    status = F.when(F.col("quality").isNull(), "skipped").when(F.col("quality") == 1, "included").otherwise("excluded")
    reason = F.when(F.col("quality") == 0, F.when(F.col("toxic") == 1, "toxic").otherwise("quality"))
    return docs.select(status.alias("status"), reason.alias("reason"), F.length("lang").alias("k")).groupBy("status", "reason").agg(F.count("*").alias("n"))


_FALLBACK = """WITH a AS (SELECT doc_id, max(toxic)::BIGINT AS a FROM labels WHERE quality = 1 GROUP BY doc_id), b AS (SELECT doc_id, n_chars AS b FROM documents WHERE n_chars > 1000)
SELECT doc_id, coalesce(a, b) AS value, CASE WHEN a IS NOT NULL THEN 'first' WHEN b IS NOT NULL THEN 'second' END AS origin FROM documents LEFT JOIN a USING (doc_id) LEFT JOIN b USING (doc_id)"""

QUERIES = {
    "rasterise_last_wins": (rasterise_last_wins, _raster_sql(False, 0.0)),
    "rasterise_clip_early": (rasterise_clip_early, _raster_sql(True, 40000.0)),
    "grid_interpolate": (grid_interpolate, f"""
WITH {EV}, {NOTES}, p AS (SELECT user_id, s0 / 21600.0::DOUBLE AS x0, log2(value) AS y0, lead(s0 / 21600.0::DOUBLE) OVER k AS x1, lead(log2(value)) OVER k AS y1, row_number() OVER k = 1 AS fst FROM n WINDOW k AS (PARTITION BY user_id ORDER BY s0, event_id)),
s AS (SELECT *, CASE WHEN fst THEN ceil(x0 - 0.5) ELSE ceil(x0) END::BIGINT AS lo, CASE WHEN x1 IS NULL THEN floor(x0 + 0.5) ELSE ceil(x1) - 1 END::BIGINT AS hi FROM p),
g AS (SELECT user_id, x0, y0, x1, y1, unnest(range(lo, hi + 1)) AS frame FROM s WHERE lo <= hi)
SELECT user_id, frame, round(pow(2.0::DOUBLE, CASE WHEN x1 IS NULL OR x1 = x0 THEN y0 ELSE y0 + (y1 - y0) * greatest(0, least(1, (frame - x0) / (x1 - x0))) END), 6) AS value FROM g
UNION ALL SELECT user_id, round_even(arg_min(x0, x0) FILTER (WHERE fst), 0)::BIGINT, round(pow(2.0::DOUBLE, arg_min(y0, x0) FILTER (WHERE fst)), 6) FROM s GROUP BY user_id HAVING NOT bool_or(lo <= hi)"""),
    "interp_clamped": (interp_clamped, f"""
WITH {EV}, {NOTES}, a AS (SELECT user_id, s0 AS x, arg_min(value, event_id) AS y FROM n WHERE event_type = 'view' GROUP BY ALL),
l AS (SELECT n.event_id, n.user_id, n.s0, a.x AS x0, a.y AS y0 FROM n ASOF LEFT JOIN a ON n.user_id = a.user_id AND n.s0 >= a.x),
r AS (SELECT l.*, a.x AS x1, a.y AS y1 FROM l ASOF LEFT JOIN a ON l.user_id = a.user_id AND l.s0 <= a.x)
SELECT event_id, round(CASE WHEN x0 IS NULL THEN y1 WHEN x1 IS NULL OR x1 = x0 THEN y0 ELSE y0 + (y1 - y0) * (s0 - x0) / (x1 - x0) END, 6) AS y FROM r"""),
    "voiced_pool": (voiced_pool, f"WITH {EV}, {FRAME_SQL} SELECT user_id, frame // 2 AS frame FROM f GROUP BY ALL HAVING bool_or(voiced)"),
    "onset_pool": (onset_pool, f"""
WITH {EV}, {FRAME_SQL}, a AS (SELECT user_id, frame // 2 AS frame, bool_or(voiced) AS v FROM f GROUP BY ALL)
SELECT user_id, frame FROM (SELECT *, lag(v) OVER (PARTITION BY user_id ORDER BY frame) AS p FROM a) WHERE v AND NOT coalesce(p, false)"""),
    "tile_windows": (tile_windows, f"WITH {EV}, n AS (SELECT user_id, count(*) AS n FROM e GROUP BY user_id) SELECT user_id, unnest(range(0, n, 32)) AS start FROM n"),
    "padded_window": (padded_window, """
WITH w AS (SELECT vec_id, list_resize(embedding[(vec_id % 64 + 1):(vec_id % 64 + 16)]::DOUBLE[], 16, 0.0::DOUBLE) AS w FROM embeddings)
SELECT vec_id, len(w)::INT AS n, round(list_sum(w), 4) AS total, w[16] AS last FROM w"""),
    "index_to_item": (index_to_item, f"""
WITH {EV}, n AS (SELECT user_id, count(*) AS n FROM e GROUP BY user_id), o AS (SELECT user_id, n, coalesce(sum(n) OVER (ORDER BY user_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS a FROM n)
SELECT o_orderkey, user_id, o_orderkey % 5000 - a AS frame FROM orders JOIN o ON o_orderkey % 5000 >= a AND o_orderkey % 5000 < a + n"""),
    "translate_labels": (translate_labels, f"""
WITH {EV}, {FRAME_SQL} SELECT user_id, frame - 3 AS frame, voiced, (onset OR (frame = 3 AND voiced)) AS onset FROM f WHERE frame - 3 >= 0 AND frame - 3 < 40"""),
    "note_ends": (note_ends, f"""
WITH {EV}, {FRAME_SQL}, m AS (SELECT user_id, max(frame) + 1 AS z FROM f GROUP BY user_id)
SELECT f.user_id, f.frame, coalesce((SELECT min(g.frame) FROM f g WHERE g.user_id = f.user_id AND g.frame > f.frame AND (NOT g.voiced OR g.onset)), z) AS "end" FROM f JOIN m USING (user_id) WHERE onset"""),
    "tail_classify": (tail_classify, f"WITH {TAILS_SQL} SELECT l_orderkey, run, round(value, 6) AS value, action FROM z"),
    "tail_flatten": (tail_flatten, f"WITH {TAILS_SQL} SELECT l_orderkey, frame, round(CASE WHEN back <= run AND action IN ('flattened', 'ambiguous-flattened') THEN value ELSE pitch END, 6) AS pitch FROM b JOIN z USING (l_orderkey)"),
    "overhang_trim": (overhang_trim, f"""
WITH {CONTOUR_SQL}, g AS (SELECT l_orderkey, count(*) AS n, min(frame) AS f0 FROM c GROUP BY l_orderkey),
m AS (SELECT c.*, n, f0 + n - n // 5 AS tail FROM c JOIN g USING (l_orderkey)), q AS (SELECT l_orderkey, avg(pitch) FILTER (WHERE frame < tail) AS body FROM m GROUP BY l_orderkey)
SELECT l_orderkey, frame, coalesce(n >= 5 AND frame >= tail AND abs(1200 * log2(pitch / body)) > 15, false) AS silent FROM m JOIN q USING (l_orderkey)"""),
    "band_join_rewards": (band_join_rewards, f"""
WITH {EV}, {NOTES} SELECT a.event_id AS a_id, b.event_id AS b_id, round(1.0::DOUBLE - abs(a.s0 - b.s0) / 20000.0::DOUBLE, 6) AS reward FROM n a JOIN n b ON a.user_id = b.user_id AND abs(a.s0 - b.s0) <= 20000 WHERE a.event_type = 'click' AND b.event_type = 'view'"""),
    "interval_overlap": (interval_overlap, f"""
WITH {EV}, {NOTES} SELECT a.event_id AS a_id, b.event_id AS b_id FROM n a JOIN n b ON a.user_id = b.user_id AND a.s0 < b.s1 AND b.s0 < a.s1 WHERE a.event_type = 'click' AND b.event_type <> 'click' AND a.s0 < a.s1 AND b.s0 < b.s1"""),
    "neighbours": (neighbours, f"""
WITH {EV}, {NOTES} SELECT a.event_id AS a_id, count(*) AS others, min(b.event_id) AS least FROM n a JOIN n b ON a.user_id = b.user_id AND abs(a.s0 - b.s0) <= 7200 AND a.event_type <> b.event_type WHERE b.value > 50 GROUP BY a.event_id"""),
    "hist_intersection_shift": (hist_intersection_shift, f"""
WITH {EV}, a AS (SELECT user_id, event_id % 24 + user_id % 3 * 12 AS v, count(*) AS a FROM e WHERE event_type = 'click' GROUP BY ALL), b AS (SELECT user_id, event_id % 24 AS v, count(*) AS b FROM e WHERE event_type = 'view' GROUP BY ALL),
s AS (SELECT user_id, greatest(coalesce((SELECT sum(a) FROM a WHERE a.user_id = u.user_id), 0), coalesce((SELECT sum(b) FROM b WHERE b.user_id = u.user_id), 0), 1) AS m FROM (SELECT user_id FROM a UNION SELECT user_id FROM b) u),
c AS (SELECT a.user_id, k AS shift, sum(least(a, b)) AS c FROM a CROSS JOIN (SELECT unnest(range(-12, 13)) AS k) JOIN b ON a.user_id = b.user_id AND a.v + k = b.v GROUP BY ALL),
q AS (SELECT c.user_id, shift, c / m AS score FROM c JOIN s USING (user_id)),
best AS (SELECT user_id, max(score) AS top, coalesce(max(score) FILTER (WHERE shift = 0), 0) AS zero FROM q GROUP BY user_id),
low AS (SELECT q.user_id, min(shift) AS shift FROM q JOIN best USING (user_id) WHERE score = top GROUP BY q.user_id)
SELECT s.user_id, CASE WHEN top > zero + 0.05::DOUBLE THEN low.shift ELSE 0 END AS shift FROM s LEFT JOIN best USING (user_id) LEFT JOIN low USING (user_id)"""),
    "multiset_intersection": (multiset_intersection, f"""
WITH {EV}, {NOTES}, a AS (SELECT user_id, midi, count(*) AS a FROM n WHERE event_type = 'click' GROUP BY ALL), b AS (SELECT user_id, midi, count(*) AS b FROM n WHERE event_type = 'view' GROUP BY ALL)
SELECT user_id, sum(least(a, b))::BIGINT AS common FROM a JOIN b USING (user_id, midi) GROUP BY user_id"""),
    "semi_split": (semi_split, "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)"),
    "anti_missing": (anti_missing, "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)"),
    "left_fallback": (left_fallback, _FALLBACK),
    "first_missing_part": (first_missing_part, """
WITH c AS (SELECT CASE WHEN c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O') THEN 'open' WHEN c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') THEN 'filled' WHEN c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') THEN 'urgent' END AS reason FROM customer)
SELECT reason, count(*) AS n FROM c GROUP BY reason"""),
    "threshold_gate": (threshold_gate, "SELECT doc_id, CASE WHEN quality >= 0.5 THEN 'fine' WHEN quality IS NOT NULL THEN 'reject' WHEN n_chars > 500 THEN 'fallback' ELSE 'none' END AS use FROM documents LEFT JOIN labels USING (doc_id)"),
    "measure_agreement": (measure_agreement, """
WITH w AS (SELECT conv_id, max(turn) + 1 AS expected, max(turn) FILTER (WHERE role = 'assistant') + 1 AS p FROM conversations GROUP BY conv_id)
SELECT conv_id, expected, coalesce(p, 0) AS performed, (p IS NULL OR abs(p - expected) <= 1) AS agrees FROM w"""),
    "set_operations": (set_operations, """
WITH a AS (SELECT o_custkey FROM orders WHERE o_totalprice > 100000), b AS (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')
SELECT 'except' AS what, count(*) AS n, sum(o_custkey)::BIGINT AS keys FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
UNION ALL SELECT 'intersect', count(*), sum(o_custkey)::BIGINT FROM (SELECT * FROM a INTERSECT ALL SELECT * FROM b)
UNION ALL SELECT 'union', count(*), sum(o_custkey)::BIGINT FROM (SELECT * FROM a UNION ALL SELECT * FROM b)
UNION ALL SELECT 'distinct', count(*), sum(o_custkey)::BIGINT FROM (SELECT * FROM a UNION SELECT * FROM b)"""),
    "manifest_counts": (manifest_counts, """
SELECT CASE WHEN quality IS NULL THEN 'skipped' WHEN quality = 1 THEN 'included' ELSE 'excluded' END AS status, CASE WHEN quality = 0 THEN CASE WHEN toxic = 1 THEN 'toxic' ELSE 'quality' END END AS reason, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ALL"""),
}

"""Readers and recipes on files whose content is made of the driver's tables, each with its SQL twin.

A file's bytes are written from rows by column functions, the library reads them as it
reads any file, and SQL says from the rows themselves what must come out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import joins as J, sequences as S, tracks as T
from ..sources import midi, scores, tables
from . import grid_queries, recipes
from .sequence_queries import EV, ORDER, events, table


def _files(df: DataFrame, key: str, text) -> DataFrame:
    return df.select(F.col(key).cast("string").alias("stem"), text.cast("binary").alias("content"))


def _listed(df: DataFrame, keys, order, item) -> DataFrame:
    """(keys, items): a list of items in order."""
    held = F.sort_array(F.collect_list(F.struct(*[F.col(o).alias(f"o{k}") for k, o in enumerate(order)], item.alias("item"))))
    return df.groupBy(*keys).agg(F.transform(held, lambda x: x["item"]).alias("items"))


def jams_contours(spark, d):
    """A user's events as one contour for each kind; observations without sound or at 0 Hz, and notes without index, are among them."""
    e = events(spark, d)
    index = F.when(F.col("event_id") % 7 != 0, (F.col("event_id") % 5).cast("int"))
    value = F.struct(index.alias("index"), F.when(F.col("event_id") % 13 == 0, 0.0).otherwise(F.col("value")).alias("frequency"), (F.col("value") > 50).alias("voiced"))
    item = F.struct((F.col("t") / F.lit(1e6)).alias("time"), F.lit(0.5).alias("duration"), value.alias("value"))
    contours = _listed(e, ["user_id", "event_type"], ORDER, item).withColumnRenamed("items", "data")
    both = _listed(contours, ["user_id"], ["event_type"], F.struct(F.lit("pitch_contour").alias("namespace"), "data"))
    other = F.array(F.struct(F.lit("beat").alias("namespace"), F.array().cast(contours.schema["data"].dataType).alias("data")))
    files = _files(both, "user_id", F.to_json(F.struct(F.concat(other, "items").alias("annotations"))))
    return tables.jams_observations(files)


def sync_lists(spark, d):
    """Points of two, of three and of one number."""
    point = F.when(F.col("event_id") % 11 == 0, F.array("value")).when(F.col("event_id") % 3 == 0, F.array("value", F.col("value") * 2, F.lit(0.5))).otherwise(F.array("value", F.col("value") * 2))
    return tables.sync_points(_files(_listed(events(spark, d), ["user_id"], ORDER, point), "user_id", F.to_json("items")))


def split_files(spark, d):
    c = table(spark, d, "customer").withColumn("split", F.element_at(F.array(F.lit("train"), F.lit("valid"), F.lit("test")), (F.col("c_custkey") % 3 + 1).cast("int")))
    stems = _listed(c, ["c_nationkey", "split"], ["c_custkey"], F.col("c_custkey").cast("string"))
    lists = stems.groupBy("c_nationkey").agg(F.map_from_entries(F.collect_list(F.struct("split", "items"))).alias("m"))
    return tables.splits(_files(lists, "c_nationkey", F.to_json("m")))


_STEPS = ("C", "D", "E", "F", "G", "A", "B")


def score_notes(spark, d):
    """An order as a score, a measure a line: a note, a chord note where the quantity is even, a rest, and a note after it."""
    li = table(spark, d, "lineitem")
    tag = lambda name, *parts: F.concat(F.lit(f"<{name}>"), *[p.cast("string") if not isinstance(p, str) else F.lit(p) for p in parts], F.lit(f"</{name}>"))
    q, part = F.col("l_quantity").cast("int"), F.col("l_partkey")
    step = F.element_at(F.array(*[F.lit(s) for s in _STEPS]), (part % 7 + 1).cast("int"))
    pitch = tag("pitch", tag("step", step), tag("alter", part % 3 - 1), tag("octave", part % 4 + 2))
    place = tag("notations", tag("technical", tag("string", part % 6 + 1), tag("fret", q % 13)))
    note = lambda first, length: tag("note", first, pitch, tag("duration", length), place)
    rest = tag("note", "<rest/>", tag("duration", F.lit(1)))
    chord = F.when(q % 2 == 0, note("<chord/>", q % 3 + 1)).otherwise("")
    head = tag("attributes", tag("divisions", F.lit(2)), tag("time", tag("beats", q % 3 + 2), tag("beat-type", F.lit(4))))
    bars = _listed(li, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"], tag("measure", head, note("", q % 3 + 1), chord, rest, note("", F.lit(1))))
    files = _files(bars, "l_orderkey", tag("score-partwise", tag("part", F.concat_ws("", "items"))))
    return scores.read_musicxml(files).where("reason IS NULL").drop("reason")


def _tabs(spark, d) -> DataFrame:
    """An order as tablature, a measure a line with a beat of one note and one of a dead or a tied note; a line with a tax of 0 changes the tempo."""
    li = table(spark, d, "lineitem")
    q = F.col("l_quantity").cast("int")
    string, fret = (F.col("l_partkey") % 6 + 1).cast("int"), (q % 20).cast("int")
    note = lambda kind: F.array(F.struct(string.alias("string"), fret.alias("fret"), kind.alias("type")))
    first = F.struct(F.lit(0).alias("tick"), F.when(F.col("l_tax") == 0, 60 + q).alias("tempo"), note(F.lit("normal")).alias("notes"))
    second = F.struct(F.lit(480).alias("tick"), F.lit(None).cast("int").alias("tempo"), note(F.when(q % 2 == 0, "tie").otherwise("dead")).alias("notes"))
    bar = F.struct((F.col("l_linenumber") - 1).alias("number"), F.lit(1920).alias("length"), F.array(first, second).alias("beats"))
    tuning = F.create_map(*[x for s, p in zip(range(1, 7), (64, 59, 55, 50, 45, 40), strict=True) for x in (F.lit(str(s)), F.lit(p))])
    bars = _listed(li, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"], bar)
    song = F.struct(F.lit(120).alias("tempo"), tuning.alias("tuning"), (F.col("l_orderkey") % 3).cast("int").alias("capo"), F.col("items").alias("measures"))
    return _files(bars, "l_orderkey", F.to_json(song))


def tab_notes(spark, d):
    return scores.read_tablature(_tabs(spark, d)).where("reason IS NULL").drop("reason")


def tab_tempos(spark, d):
    return scores.read_tempos(_tabs(spark, d)).where("reason IS NULL").drop("reason").groupBy("stem", "tick", "bpm").agg(F.count("*").alias("n"))


def _hex(value, digits: int):
    return F.lpad(F.hex(value.cast("long")), digits, "0")


def _midi(spark, d, string: bool) -> DataFrame:
    """A user's events as a MIDI file: notes one after another, each with a pause before it; a tempo of its own. With ``string``, in the first string's track."""
    length, pause = F.col("event_id") % 100 + 1, F.col("event_id") % 7
    pitch = F.col("event_id") % 60 + 30
    note = F.concat(_hex(pause, 2), F.lit("90"), _hex(pitch, 2), F.lit("40"), _hex(length, 2), F.lit("80"), _hex(pitch, 2), F.lit("00"))
    body = _listed(events(spark, d), ["user_id"], ORDER, note).withColumn("body", F.concat_ws("", "items"))
    tempo = F.concat(F.lit("00FF5103"), _hex(F.lit(400_000) + F.col("user_id") * 100, 6))
    chunk = lambda data: F.concat(F.lit("4D54726B"), _hex(F.length(data) / 2, 8), data)
    head = F.lit("4D546864" + "00000006" + "0001" + "0002" + "01E0")
    return body.select(F.col("user_id").cast("string").alias("stem"), F.unhex(F.concat(head, chunk(tempo), chunk(F.col("body")))).alias("content"))


def midi_notes(spark, d):
    n = midi.read_merged(_midi(spark, d, False)).where("reason IS NULL")
    return n.select("stem", "idx", F.round("onset", 9).alias("onset"), F.round("offset", 9).alias("offset"), "pitch")


def midi_string_notes(spark, d):
    n = midi.read_strings(_midi(spark, d, True), 23.0).where("reason IS NULL")
    return n.select("stem", "idx", "string", F.round("start", 9).alias("start"), F.round("end", 9).alias("end"), "pitch")


def gated_takes(spark, d):
    """The gate on alignment scores as text: blank, no number, under and over the threshold; without a fine alignment the coarse one."""
    c = table(spark, d, "customer")
    score = F.when(F.col("c_custkey") % 5 == 0, "  ").when(F.col("c_custkey") % 7 == 0, "n/a").otherwise((F.col("c_custkey") % 100 / 100).cast("string"))
    path = lambda kind, by: F.when(F.col("c_custkey") % by != 0, F.concat(F.lit(f"{kind}/"), F.col("c_custkey").cast("string")))
    return recipes.gated(c.select("c_custkey", path("fine", 3).alias("fine"), path("coarse", 4).alias("coarse"), score.alias("score"))).select("c_custkey", "notes", "reason")


def measures_checked(spark, d):
    """Scores' last measures against sync points' last ones; some tracks have no points, some points an offset."""
    c = table(spark, d, "conversations")
    score = c.select(F.col("conv_id").alias("stem"), F.col("turn").cast("int").alias("measure"))
    sync = c.where("conv_id % 4 <> 0").select(F.col("conv_id").alias("stem"), (F.col("turn") - F.col("conv_id") % 4).cast("double").alias("measure"), F.when(F.col("turn") % 5 == 4, 0.5).alias("offset"))
    return recipes.measures_agree(score, sync)


def attack_peaks(spark, d):
    """Rises of the energy of at least 3 dB that are local maxima, level tops by their middle."""
    v = T.block_levels(table(spark, d, "embeddings"), "embedding", 8, 4)
    rise = F.transform("levels", lambda x, i: F.when(i == 0, F.lit(0.0)).otherwise(F.round(x - F.element_at("levels", i), 2)))
    return v.select("vec_id", F.explode(T.level_peaks(rise, 3.0)).alias("place"))


def level_tops(spark, d):
    """Peaks of vectors in coarse steps, where level tops are many."""
    v = table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * 8)).alias("steps"))
    return v.select("vec_id", F.explode(T.level_peaks("steps", 1.0)).alias("place"))


def unmatched_users(spark, d):
    """Customers that no event is of."""
    users = events(spark, d).select(F.col("user_id").alias("c_custkey"))
    return J.missing(table(spark, d, "customer").select("c_custkey"), users, ["c_custkey"])


def string_grid(spark, d):
    """Notes with a string on the grid, tuned up by 10 cents; a note that continues another has no onset, one without a string no frames."""
    n = grid_queries._notes(spark, d)
    n = S.continuations(n, ["user_id"], ["s0", "event_id"], "s0", "s1", 3600.0)
    notes = n.select(F.col("user_id").alias("stem"), (F.col("event_id") % 4 - 1).cast("int").alias("string"), F.col("event_id").alias("idx"), F.col("s0").alias("onset"), F.col("s1").alias("offset"), F.col("midi").alias("pitch"), "continues")
    lengths = n.select(F.col("user_id").alias("stem"), (1000 + F.col("user_id") % 500).cast("long").alias("n_frames")).distinct()
    f = recipes.note_grid(notes, lengths, grid_queries.HOP, cents=10.0)
    return f.groupBy("stem", "string").agg(F.count("*").alias("frames"), F.sum("frame").cast("long").alias("places"), F.count_if("onset").alias("onsets"), F.round(F.sum(F.log2(F.col("pitch").cast("double"))), 2).alias("pitches"))


_LEVELS = """l AS (SELECT vec_id, list_transform(range(15), lambda k: 10 * log10(list_sum(list_transform(range(k * 4 + 1, k * 4 + 9), lambda i: CASE WHEN i = 1 THEN 0.0::DOUBLE ELSE pow(embedding[i]::DOUBLE - embedding[i - 1]::DOUBLE, 2) END)) + 1e-12::DOUBLE)) AS levels FROM embeddings)"""


def _peaks_sql(points: str, height: float) -> str:
    """Peaks of rows (vec_id, k, x): runs of one level between lower ones."""
    return f"""
WITH {points},
c AS (SELECT *, CASE WHEN lag(x) OVER w IS DISTINCT FROM x THEN 1 ELSE 0 END AS s FROM p WINDOW w AS (PARTITION BY vec_id ORDER BY k)),
r AS (SELECT vec_id, x, g, min(k) AS a, max(k) AS b FROM (SELECT *, sum(s) OVER (PARTITION BY vec_id ORDER BY k) AS g FROM c) GROUP BY ALL),
t AS (SELECT *, lag(x) OVER w AS before, lead(x) OVER w AS after FROM r WINDOW w AS (PARTITION BY vec_id ORDER BY g))
SELECT vec_id, ((a + b) // 2)::INT AS place FROM t WHERE before < x AND after < x AND x >= {height}"""


_TICKS = f"""{EV}, k AS (SELECT *, event_id % 100 + 1 AS len, event_id % 7 AS pause FROM e),
s AS (SELECT *, sum(pause + len) OVER w - len AS a, sum(pause + len) OVER w AS z, row_number() OVER w - 1 AS idx FROM k WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id))"""

#: Order-preserving alignment in SQL: the rows of the dynamic programme, then the way back.
ALIGN_SQL = f"""
WITH RECURSIVE {EV},
c AS (SELECT user_id, event_id AS idx, t / 3.6e9 - 473352 AS x, event_id % 4 AS p FROM e WHERE event_type = 'click'),
o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY x, idx) AS k FROM c),
g AS (SELECT user_id, k, idx, x, p, x AS anchor FROM o WHERE k = 1
  UNION ALL SELECT o.user_id, o.k, o.idx, o.x, o.p, CASE WHEN o.x - g.anchor > 0.5 THEN o.x ELSE g.anchor END FROM g JOIN o ON o.user_id = g.user_id AND o.k = g.k + 1),
a AS (SELECT user_id, idx, x, p, row_number() OVER (PARTITION BY user_id ORDER BY anchor, p, k) AS i FROM g),
v AS (SELECT user_id, event_id AS idx, t / 3.6e9 - 473352 AS x, event_id % 4 AS p FROM e WHERE event_type = 'view'),
b AS (SELECT user_id, list(struct_pack(idx := idx, x := x, p := p) ORDER BY x, p, idx) AS b, count(*) AS m FROM v GROUP BY user_id),
n AS (SELECT user_id, count(*) AS n FROM a GROUP BY user_id),
w AS (SELECT user_id, 0::BIGINT AS i, list_transform(range(m + 1), lambda z: 0.0::DOUBLE) AS score FROM b
  UNION ALL SELECT user_id, i, list_transform(range(1, len(cell) + 1), lambda z: list_max(cell[1:z])) FROM (
    SELECT w.user_id, a.i, list_prepend(w.score[1], list_transform(range(1, m + 1), lambda z: CASE WHEN b.b[z].p = a.p AND abs(b.b[z].x - a.x) <= 24 THEN greatest(w.score[z + 1], w.score[z] + (1 - abs(b.b[z].x - a.x) / 24.0::DOUBLE) + 0.6::DOUBLE) ELSE w.score[z + 1] END)) AS cell
    FROM w JOIN a ON a.user_id = w.user_id AND a.i = w.i + 1 JOIN b ON b.user_id = w.user_id)),
y AS (SELECT user_id, n AS i, m AS j, NULL::BIGINT AS idx, NULL::BIGINT AS other_idx FROM n JOIN b USING (user_id)
  UNION ALL SELECT user_id, CASE WHEN move > 0 THEN i - 1 ELSE i END, CASE WHEN move <> 1 THEN j - 1 ELSE j END, CASE WHEN move = 2 THEN mine END, CASE WHEN move = 2 THEN theirs END FROM (
    SELECT *, CASE WHEN abs(score - met) <= 1e-3 + 1e-5 * abs(met - 0.3 * (i + j)) THEN 2 WHEN abs(score - skip) <= 1e-3 + 1e-5 * abs(skip - 0.3 * (i + j)) THEN 1 ELSE 0 END AS move FROM (
      SELECT y.user_id, y.i, y.j, a.idx AS mine, b.b[y.j].idx AS theirs, q.score[y.j + 1] AS score, r.score[y.j + 1] AS skip,
        CASE WHEN b.b[y.j].p = a.p AND abs(b.b[y.j].x - a.x) <= 24 THEN r.score[y.j] + (1 - abs(b.b[y.j].x - a.x) / 24.0::DOUBLE) + 0.6::DOUBLE END AS met
      FROM y JOIN a ON a.user_id = y.user_id AND a.i = y.i JOIN b ON b.user_id = y.user_id JOIN w q ON q.user_id = y.user_id AND q.i = y.i JOIN w r ON r.user_id = y.user_id AND r.i = y.i - 1 WHERE y.i > 0 AND y.j > 0)))
SELECT user_id, idx, other_idx FROM y WHERE idx IS NOT NULL"""

#: Greedy strings in SQL: note after note, with all notes that are held.
ASSIGN_SQL = f"""
WITH RECURSIVE {EV},
n AS (SELECT user_id, event_id AS idx, t / 1e6 AS a, t / 1e6 + value * 400 AS z, event_id % 60 + 30 AS p, CASE WHEN event_type = 'purchase' THEN (event_id % 6)::INT END AS g, row_number() OVER (PARTITION BY user_id ORDER BY t / 1e6, event_id) AS k FROM e),
f AS (SELECT user_id, coalesce(list(struct_pack(s := g, a := a, z := z)) FILTER (WHERE g IS NOT NULL), []) AS held FROM n GROUP BY user_id),
r AS (SELECT user_id, 0::BIGINT AS k, NULL::BIGINT AS idx, NULL::INT AS string, NULL::BOOLEAN AS given, held FROM f
  UNION ALL SELECT user_id, k, idx, string, g IS NOT NULL, CASE WHEN g IS NULL AND string >= 0 THEN list_append(held, struct_pack(s := string, a := a, z := z)) ELSE held END FROM (
    SELECT *, coalesce(g, list_filter(able, lambda s: len(list_filter(held, lambda h: h.s = s AND a < h.z AND h.a < z)) = 0)[1], able[1], -1)::INT AS string FROM (
      SELECT n.user_id, n.k, n.idx, n.a, n.z, n.g, r.held, list_filter([5, 4, 3, 2, 1, 0], lambda s: n.p - [40, 45, 50, 55, 59, 64][s + 1] BETWEEN 0 AND 19) AS able
      FROM r JOIN n ON n.user_id = r.user_id AND n.k = r.k + 1)))
SELECT user_id, idx, string, given FROM r WHERE k > 0"""

QUERIES = {
    "jams_contours": (jams_contours, f"""
WITH {EV}, s AS (SELECT *, dense_rank() OVER (PARTITION BY user_id ORDER BY event_type) - 1 AS string, row_number() OVER (PARTITION BY user_id, event_type ORDER BY t, event_id) - 1 AS idx FROM e)
SELECT user_id::VARCHAR AS stem, string::INT AS string, idx, t / 1e6 AS time, value AS frequency, CASE WHEN event_id % 7 <> 0 THEN event_id % 5 ELSE 0 END::INT AS note_id FROM s WHERE value > 50 AND event_id % 13 <> 0"""),
    "sync_lists": (sync_lists, f"""
WITH {EV}, s AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) - 1 AS idx FROM e)
SELECT user_id::VARCHAR AS stem, idx, value AS measure, value * 2 AS seconds, CASE WHEN event_id % 3 = 0 THEN 0.5::DOUBLE END AS "offset" FROM s WHERE event_id % 11 <> 0"""),
    "split_files": (split_files, """
SELECT c_nationkey::VARCHAR AS dataset, ['train', 'valid', 'test'][(c_custkey % 3 + 1)::INT] AS split, (row_number() OVER (PARTITION BY c_nationkey, c_custkey % 3 ORDER BY c_custkey) - 1)::INT AS place, c_custkey::VARCHAR AS stem FROM customer"""),
    "score_notes": (score_notes, """
WITH l AS (SELECT *, l_quantity::INT AS q, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) - 1 AS measure FROM lineitem),
x AS (SELECT *, 0 AS part, 0 AS "offset" FROM l UNION ALL SELECT *, 1, 0 FROM l WHERE q % 2 = 0 UNION ALL SELECT *, 2, q % 3 + 2 FROM l)
SELECT l_orderkey::VARCHAR AS stem, row_number() OVER (PARTITION BY l_orderkey ORDER BY measure, part) - 1 AS idx, measure::INT AS measure, "offset"::INT AS "offset", ((q % 3 + 2) * 2)::INT AS measure_len,
  ([0, 2, 4, 5, 7, 9, 11][(l_partkey % 7 + 1)::INT] + 12 * (l_partkey % 4 + 3) + l_partkey % 3 - 1)::INT AS pitch, (l_partkey % 6 + 1)::INT AS string, (q % 13)::INT AS fret FROM x"""),
    "tab_notes": (tab_notes, """
WITH l AS (SELECT *, l_quantity::INT AS q, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) - 1) * 1920 AS a FROM lineitem),
x AS (SELECT *, 0 AS o FROM l UNION ALL SELECT *, 480 FROM l WHERE q % 2 <> 0)
SELECT l_orderkey::VARCHAR AS stem, row_number() OVER (PARTITION BY l_orderkey ORDER BY a + o) - 1 AS idx, a + o AS tick, (l_linenumber - 1)::INT AS measure, o::INT AS "offset", 1920::INT AS measure_len,
  ([64, 59, 55, 50, 45, 40][(l_partkey % 6 + 1)::INT] + l_orderkey % 3 + q % 20)::INT AS pitch, (l_partkey % 6 + 1)::INT AS string, (q % 20)::INT AS fret FROM x"""),
    "tab_tempos": (tab_tempos, """
WITH l AS (SELECT *, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) - 1) * 1920 AS tick FROM lineitem),
x AS (SELECT l_orderkey, tick, 60 + l_quantity::INT AS bpm FROM l WHERE l_tax = 0 UNION ALL SELECT DISTINCT l_orderkey, 0, 120 FROM lineitem)
SELECT l_orderkey::VARCHAR AS stem, tick, bpm::DOUBLE AS bpm, count(*) AS n FROM x GROUP BY ALL"""),
    "midi_notes": (midi_notes, f"""
WITH {_TICKS} SELECT user_id::VARCHAR AS stem, idx, round(a * ((400000 + user_id * 100) * 1e-6 / 480), 9) AS onset, round(z * ((400000 + user_id * 100) * 1e-6 / 480), 9) AS "offset", (event_id % 60 + 30)::INT AS pitch FROM s"""),
    "midi_string_notes": (midi_string_notes, f"""
WITH {_TICKS}, q AS (SELECT *, a * ((400000 + user_id * 100) * 1e-6 / 480) - 0.023 AS x, z * ((400000 + user_id * 100) * 1e-6 / 480) - 0.023 AS y FROM s)
SELECT user_id::VARCHAR AS stem, row_number() OVER (PARTITION BY user_id ORDER BY idx) - 1 AS idx, {midi.TRACK_STRINGS[0]}::INT AS string, round(greatest(x, 0), 9) AS start, round(y, 9) AS "end", (event_id % 60 + 30)::INT AS pitch FROM q WHERE y > greatest(x, 0)"""),
    "gated_takes": (gated_takes, """
WITH t AS (SELECT c_custkey, c_custkey % 3 <> 0 AS fine, c_custkey % 4 <> 0 AS coarse, CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 7 <> 0 THEN c_custkey % 100 / 100.0::DOUBLE END AS score FROM customer)
SELECT c_custkey, CASE WHEN fine AND (score IS NULL OR score >= 0.5) THEN 'fine/' || c_custkey WHEN NOT fine AND coarse THEN 'coarse/' || c_custkey END AS notes,
  CASE WHEN fine AND score < 0.5 THEN 'alignment score too low' WHEN NOT fine AND NOT coarse THEN 'no notes' END AS reason FROM t"""),
    "measures_checked": (measures_checked, """
WITH s AS (SELECT conv_id, (max(turn) + 1)::INT AS performed FROM conversations GROUP BY conv_id),
p AS (SELECT conv_id, max(turn - conv_id % 4) + 1 AS expected FROM conversations WHERE conv_id % 4 <> 0 AND turn % 5 <> 4 GROUP BY conv_id)
SELECT conv_id AS stem, performed, expected, (expected IS NULL OR abs(performed - expected) <= 1) AS agrees FROM s LEFT JOIN p USING (conv_id)"""),
    "attack_peaks": (attack_peaks, _peaks_sql(f"{_LEVELS}, p AS (SELECT vec_id, k - 1 AS k, CASE WHEN k = 1 THEN 0 ELSE round(levels[k] - levels[k - 1], 2) END AS x FROM (SELECT vec_id, levels, unnest(range(1, 16)) AS k FROM l))", 3.0)),
    "level_tops": (level_tops, _peaks_sql("p AS (SELECT vec_id, k - 1 AS k, floor(embedding[k]::DOUBLE * 8) AS x FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS k FROM embeddings))", 1.0)),
    "unmatched_users": (unmatched_users, "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)"),
    "string_grid": (string_grid, f"""
WITH {EV}, {grid_queries.NOTES}, q AS (SELECT *, coalesce(s0 - lag(s1) OVER (PARTITION BY user_id ORDER BY s0, event_id) < 3600, false) AS continues FROM n),
r AS (SELECT *, event_id % 4 - 1 AS string, round_even(s0 / {grid_queries.HOP}::DOUBLE, 0)::BIGINT AS f, round_even(s1 / {grid_queries.HOP}::DOUBLE, 0)::BIGINT AS l, 1000 + user_id % 500 AS size FROM q WHERE event_id % 4 > 0),
b AS (SELECT *, greatest(f, 0) AS a, least(greatest(f + 1, l), size) AS z FROM r),
x AS (SELECT user_id, string, event_id, midi, continues, a, unnest(range(a, z)) AS frame FROM b WHERE a < z),
y AS (SELECT user_id, string, frame, arg_max(midi, event_id) AS midi, bool_or(frame = a AND NOT continues) AS onset FROM x GROUP BY ALL)
SELECT user_id AS stem, string::INT AS string, count(*) AS frames, sum(frame)::BIGINT AS places, count(*) FILTER (WHERE onset) AS onsets, round(sum(log2((440 * pow(2.0::DOUBLE, (midi - 69) / 12.0::DOUBLE) * pow(2.0::DOUBLE, 10.0::DOUBLE / 1200))::FLOAT::DOUBLE)), 2) AS pitches FROM y GROUP BY ALL"""),
}

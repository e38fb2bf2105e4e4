"""One registered query per operator: it applies the operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat_format, quality, token_records, toxicity, warc
from .decontaminate import matches
from .jaccard_join import jaccard_groups
from .line_templates import without_templates
from .mixing import mix
from .stream_dedup import exact_dedup

#: File of the tokenizer that the queries encode with.
TOKENIZER = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(TOKENIZER))


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    return chat_format.digests(chat_format.prefix_targets(turns.unionByName(more))).drop("example_chars")


def op2_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = without_templates(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.length("text").cast("long").alias("kept_chars"), F.sha2("text", 256).alias("kept_sha256"))


def op3_quality_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


def op4_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_records.round_trip(_table(spark, sf_dir, "documents"), tokenizer_path(), memory=1_400_000)


def op6_streaming_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark, f"{sf_dir}/documents.parquet")


def op7_benchmark_edit_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents")).taken()


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_chat_formatting, op2_line_templates, op3_quality_co_training, op4_warc_normaliser, op5_token_records, op6_streaming_dedup, op7_benchmark_edit_matching, op8_source_mixing, op9_ngram_jaccard_join, op10_toxicity)
    return {f.__name__: f for f in found}


ORACLE = {
    "op1_chat_formatting": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r, text AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]', 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]', 'assistant', '</s>[INST] ok [/INST]'
), measured AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST) AS place,
    length(text) + len(regexp_extract_all(text, '\\|<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]|<s>|</s>|<<ROLE>>|<<SAYS>>|<</ROLE>>')) AS escaped,
    length(role) + len(regexp_extract_all(role, '\\|<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]|<s>|</s>|<<ROLE>>|<<SAYS>>|<</ROLE>>')) AS escaped_role
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(escaped + CASE role WHEN 'system' THEN 18 WHEN 'user' THEN 16 WHEN 'assistant' THEN 10 ELSE 9 + escaped_role + 10 + 11 END)::BIGINT AS formatted_chars,
  (count(*) FILTER (WHERE role = 'assistant') + CASE WHEN arg_max(role, place) = 'assistant' THEN 0 ELSE 1 END)::BIGINT AS n_examples
FROM measured GROUP BY conv_id
""",
    "op2_line_templates": r"""
WITH k AS (SELECT *, row_number() OVER () AS key FROM (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL)
), l AS (SELECT key, number, line, list_transform(list_filter(string_split_regex(line, '[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'), lambda x: x <> ''), lambda x: CASE WHEN regexp_matches(x, '\p{Nd}') THEN '<*>' ELSE x END) AS w
  FROM (SELECT key, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS number, unnest(string_split(text, chr(10))) AS line FROM k)
), x AS (SELECT DISTINCT key, w, struct_pack(n := len(w), first := w[1:3]) AS leaf FROM l WHERE len(w) > 0
), t AS (SELECT leaf, w, key, unnest(range(1, len(w) + 1)) AS place, unnest(w) AS token FROM x
), c AS (SELECT leaf, place, token FROM t WHERE token <> '<*>' GROUP BY ALL HAVING count(DISTINCT key) >= 5
), s AS (
  SELECT leaf, w, list(struct_pack(place := place, token := token) ORDER BY place) FILTER (WHERE c.place IS NOT NULL) AS template
  FROM (SELECT DISTINCT leaf, w, place, token FROM t) LEFT JOIN c USING (leaf, place, token) GROUP BY leaf, w HAVING count(c.place) >= 0.5 * len(w)
), r AS (SELECT leaf, template FROM s JOIN x USING (leaf, w) GROUP BY ALL HAVING count(DISTINCT key) >= 5
), gone AS (SELECT w FROM s JOIN r ON s.leaf = r.leaf AND s.template = r.template
), kept AS (
  SELECT key, count(*) AS n_lines, count(gone.w) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY number) FILTER (WHERE gone.w IS NULL), '') AS text FROM l LEFT JOIN gone ON l.w = gone.w GROUP BY key
)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped, length(kept.text)::BIGINT AS kept_chars, sha256(kept.text) AS kept_sha256
FROM documents d LEFT JOIN k ON d.doc_id IS NOT DISTINCT FROM k.doc_id AND d.text = k.text LEFT JOIN kept USING (key)
""",
    "op4_warc_normaliser": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, octet_length(encode(html)) AS payload_bytes, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
""",
    "op6_streaming_dedup": r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
""",
    "op9_ngram_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS sh
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(1, len(ws) - 4) + 1)) AS i FROM w WHERE len(ws) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
), both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach(node, other) AS (
  SELECT a, b FROM both_ways UNION SELECT r.node, l.b FROM reach r JOIN both_ways l ON l.a = r.other
)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(least(w.doc_id, r.m), w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT node AS doc_id, min(other) AS m FROM reach GROUP BY node) r USING (doc_id)
""",
}

"""Each operator over its whole tables: name -> (spark, sf_dir) -> DataFrame, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spanledger.llm import (
    centroids, chat, decontaminate, jaccard, line_dedup, lm_score, merkle, pieces, quality_model, quality_rules, suffix_dedup, url_filter, warc,
)
from spanledger.llm.common import table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "posterior", "kept"
    )


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), pieces.read_model(pieces.default_model()))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = chat.END.strip() + chat.START + "assistant ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.sql(
        f"SELECT CAST(-1 AS BIGINT) AS conv_id, turn, role, '{probe}' AS text FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)"
    )
    return chat.digests(chat.format_conversations(chat.linear(rows.unionByName(extra))))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_warc": op3_warc,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_url_filter": op5_url_filter,
    "op6_quality_rules": op6_quality_rules,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_chat_format": op9_chat_format,
    "op10_lm_score": op10_lm_score,
    "op11_merkle": merkle.op11_merkle,
    "op12_centroids": centroids.op12_centroids,
    "op13_line_dedup": line_dedup.op13_line_dedup,
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce({_WORDS.format("text")}, []) AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, coalesce({_WORDS.format("text")}, []) AS w FROM benchmark),
g AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS gram
  FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(i) WHERE len(w) > 0
),
sizes AS (SELECT DISTINCT n FROM g),
h AS (
  SELECT r, i, s.n, item FROM d, sizes s, unnest(range(1, len(w) - s.n + 2)) AS t(i), g
  WHERE g.n = s.n AND g.gram = array_to_string(w[i : i + s.n - 1], ' ')
),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM h, unnest(range(i, i + n)) AS t(p) GROUP BY r),
items AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM h GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

_WARC = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
),
q AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to
FROM q
"""

_URL_FILTER = f"""
WITH rules(rule, rule_verdict) AS (
  VALUES ('com/', 'allow'), ('example.com/en/', 'block'), ('www.example.com/en/', 'allow'), ('net/es/', 'block'), ('net/fr/', 'block')
),
rest AS (
  SELECT page_id, row_number() OVER () AS r,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS x FROM pages
),
parts AS (
  SELECT page_id, r, {_LOWER.format("regexp_extract(x, '^([^/?#]*)', 1)")} AS host, regexp_extract(x, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
),
fits AS (
  SELECT r, arg_max(rule, length(rule)) AS rule, arg_max(rule_verdict, length(rule)) AS rule_verdict FROM parts, rules
  WHERE (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
    AND starts_with(path, substr(rule, instr(rule, '/'))) GROUP BY r
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IS NOT NULL THEN rule_verdict
  WHEN host = '' OR regexp_matches(host, '(^|[.])(spam-farm|ads|adserver)[.]') OR ends_with(path, '/wp-login.php') OR contains(path, '/cgi-bin/')
  THEN 'block' ELSE 'allow' END AS verdict
FROM parts LEFT JOIN fits USING (r)
"""

_ESCAPED = r"replace(replace({}, '\', '\\'), '<|', '<\|')"
_CHAT = f"""
WITH c AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, t, r, '{chat.END.strip()}{chat.START}assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(t, r)
),
t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k FROM c
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(24 + length(replace({_ESCAPED.format("role")}, chr(10), '\\n')) + length({_ESCAPED.format("text")})) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

ORACLES = {
    "op1_decontaminate": _DECONTAMINATE,
    "op3_warc": _WARC,
    "op5_url_filter": _URL_FILTER,
    "op9_chat_format": _CHAT,
    "op11_merkle": merkle.ORACLE,
    "op12_centroids": centroids.ORACLE,
    "op13_line_dedup": line_dedup.ORACLE,
}

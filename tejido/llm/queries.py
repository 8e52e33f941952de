"""The registered queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat, langid, line_dedup, lz_fingerprint, metric_join, mixing, periodic, simhash, substring_dedup, token_counts, warc, whitening


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_lz_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lz_fingerprint.edit_ring(table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.passages(table(spark, sf_dir, "documents"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_join.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = token_counts.read_vocabulary(tokenizer_path("byte_bpe_50k.json"))
    return token_counts.token_report(table(spark, sf_dir, "documents"), vocabulary, limit=1024)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe.read_ranks(tokenizer_path("byte_bpe_multi_50k.tiktoken"))
    return bpe.round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op10_chat_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted(table(spark, sf_dir, "conversations"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(table(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.report(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (
        op1_lz_fingerprints, op2_warc, op3_simhash, op4_language_id, op5_substring_dedup, op6_source_mixing, op7_embedding_join, op8_token_counts, op9_byte_bpe, op10_chat_tool_calls,
        op11_line_dedup, op12_whitening, op13_periodic_runs,
    )
    return {f.__name__: f for f in ops}


OP2_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest FROM p
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS latest FROM d
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < latest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < latest THEN latest END AS refers_to
FROM g
"""


OP7_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
    AND len(list_filter(embedding, lambda e: e <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.95
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON n.a = e.vec_id
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = e.vec_id
"""


#: No text of the tables holds a call as JSON; tests cover those.
OP10_SQL = """
WITH m AS (
  SELECT conv_id, turn, role, text, count(*) AS n_copies FROM conversations GROUP BY ALL
), u AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY text) AS k FROM m WHERE role = 'user' AND conv_id IS NOT NULL AND turn IS NOT NULL
), calls AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS depth,
    lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS before, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS following
  FROM u WHERE k = 1
), met AS (
  SELECT calls.conv_id, calls.turn, r.turn AS result_turn, r.text AS content,
    row_number() OVER (PARTITION BY calls.conv_id, calls.turn ORDER BY r.turn, r.text) AS k,
    CAST(count(r.turn) OVER (PARTITION BY calls.conv_id, calls.turn) AS BIGINT) AS n_results
  FROM calls LEFT JOIN m r ON r.role = 'assistant' AND r.conv_id = calls.conv_id AND r.turn > calls.turn
    AND (r.turn <= calls.following OR calls.following IS NULL)
), told AS (
  SELECT calls.*, result_turn, content, n_results, CAST(coalesce(length(text), 0) = 0 AS BIGINT) AS n_faults,
    CASE WHEN coalesce(length(text), 0) = 0 THEN 'invalid' WHEN result_turn IS NOT NULL THEN 'answered' ELSE 'open' END AS status,
    '{"prompt":' || coalesce(CAST(to_json(text) AS VARCHAR), 'null') || ',"turn":' || calls.turn || '}' AS arguments_json
  FROM calls JOIN met ON met.conv_id = calls.conv_id AND met.turn = calls.turn AND met.k = 1
), rest AS (
  SELECT m.conv_id, m.turn, m.role, m.text, m.n_copies,
    CASE WHEN m.role = 'assistant' AND m.turn IS NOT NULL THEN (SELECT max(c.turn) FROM calls c WHERE c.conv_id = m.conv_id AND c.turn < m.turn) END AS last,
    CASE WHEN m.conv_id IS NULL OR m.turn IS NULL THEN 'rejected' WHEN m.role = 'user' THEN 'repeated' ELSE 'kept' END AS status
  FROM m LEFT JOIN u ON u.conv_id = m.conv_id AND u.turn = m.turn AND m.role = 'user' AND u.text IS NOT DISTINCT FROM m.text AND u.k = 1
  WHERE u.k IS NULL
)
SELECT conv_id, turn, 'user' AS role, 'call' AS kind, 'call_' || turn AS call_id, 'reply' AS tool, depth, status, n_faults, arguments_json, result_turn, n_results, n_copies,
  '{' || CASE WHEN before IS NULL THEN '' ELSE '"after":"call_' || before || '",' END || '"arguments":' || arguments_json
  || ',"id":"call_' || turn || '","name":"reply","result":' || coalesce(CAST(to_json(content) AS VARCHAR), 'null') || ',"status":"' || status || '"}' AS record
FROM told
UNION ALL
SELECT conv_id, turn, role, CASE WHEN last IS NULL THEN 'message' ELSE 'result' END, 'call_' || last, NULL, NULL,
  CASE WHEN last IS NOT NULL THEN 'linked' WHEN role = 'assistant' AND status = 'kept' THEN 'unlinked' ELSE status END, NULL, NULL, NULL, NULL, n_copies,
  '{' || CASE WHEN last IS NULL THEN '' ELSE '"call":"call_' || last || '",' END || '"content":' || coalesce(CAST(to_json(text) AS VARCHAR), 'null')
  || ',"role":' || coalesce(CAST(to_json(role) AS VARCHAR), 'null') || ',"turn":' || coalesce(CAST(turn AS VARCHAR), 'null') || '}'
FROM rest
"""


OP11_SQL = """
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), told AS (
  SELECT row_number() OVER () AS r, doc_id, lines FROM split
), each AS (
  SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM told
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM each
), firsts AS (
  SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= 10 GROUP BY k
), marked AS (
  SELECT keyed.*, coalesce(doc_id > first, false) AS gone FROM keyed LEFT JOIN firsts ON firsts.k = keyed.k AND length(keyed.k) >= 10
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op11_line_dedup": OP11_SQL, "op2_warc": OP2_SQL, "op7_embedding_join": OP7_SQL, "op10_chat_tool_calls": OP10_SQL}

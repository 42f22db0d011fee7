"""The thin contract queries opN_<name>: each applies its operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Fixed values of the contract.
URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "allow"), ("com/fr/", "allow"), ("com/de/", "block")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import judge

    return judge(table(spark, sf_dir, "pages"), URL_RULES)


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import join

    return join(table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .bpe import digests

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import archive, read_back

    store = archive(table(spark, sf_dir, "pages"))
    out = read_back(store)
    store.drop()
    return out


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import report

    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: What a user's turn must be to count as a valid call in op6_chat. The bounds are chosen so that some turns break them.
ANSWER_SCHEMA = {
    "answer": {
        "required": ["lines", "text", "turn"],
        "properties": {"lines": {"type": "integer", "minimum": 0, "maximum": 2}, "text": {"type": "string", "minLength": 24}, "turn": {"type": "integer", "minimum": 0}},
        "additionalProperties": False,
    }
}


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns as calls and assistant turns as results, with identifiers and dependencies that `from_turns` gives them."""
    from pyspark.sql import functions as F

    from .chat import formatted, from_turns

    out = formatted(*from_turns(table(spark, sf_dir, "conversations"), "answer"), ANSWER_SCHEMA)
    return out.withColumn("errors", F.array_join("errors", "; "))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_mpegts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mpegts import features, media_table

    return features(media_table(table(spark, sf_dir, "documents")))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import dedup

    return dedup(table(spark, sf_dir, "documents"))


OP4_SQL = """
WITH page AS (
  SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS digest, octet_length(encode(coalesce(html, ''))) AS n FROM pages
), named AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first_id FROM page)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id > first_id THEN first_id END AS refers_to
FROM named
"""


OP6_SQL = """
WITH RECURSIVE m AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
u AS (SELECT conv_id, min(turn) AS first, max(turn) AS last FROM m WHERE role = 'user' GROUP BY 1),
calls AS (
  SELECT conv_id, turn, text, length(text) - length(replace(text, chr(10), '')) AS lines, conv_id || ':' || CASE WHEN conv_id % 5 = 3 THEN turn // 4 ELSE turn END AS call_id,
    CASE conv_id % 5 WHEN 0 THEN CASE WHEN turn < last THEN conv_id || ':' || (turn + 2) END
      WHEN 1 THEN conv_id || ':' || (turn - 2)
      WHEN 2 THEN conv_id || ':' || CASE WHEN turn = first THEN last ELSE turn - 2 END
      WHEN 3 THEN CASE WHEN turn > first AND (turn - 2) // 4 <> turn // 4 THEN conv_id || ':' || ((turn - 2) // 4) END
      ELSE CASE WHEN turn > first THEN conv_id || ':' || (turn - 2) END END AS need
  FROM m JOIN u USING (conv_id) WHERE role = 'user'
),
spelled AS (
  SELECT *, json_object('lines', lines, 'text', text, 'turn', turn) AS arguments,
    concat_ws('; ', CASE WHEN lines > 2 THEN 'lines: too large' END, CASE WHEN length(text) < 24 THEN 'text: too short' END) AS errors FROM calls
),
ranked_calls AS (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY turn, arguments::VARCHAR) AS k FROM spelled),
results AS (
  SELECT conv_id, turn, text, conv_id || ':' || CASE conv_id % 5 WHEN 3 THEN (turn - 1) // 4 WHEN 4 THEN turn + 1 ELSE turn - 1 END AS call_id FROM m WHERE role = 'assistant'
),
ranked_results AS (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY turn, text) AS k FROM results),
nodes AS (SELECT c.call_id, c.turn, c.need, r.turn AS result_turn FROM ranked_calls c LEFT JOIN ranked_results r ON r.call_id = c.call_id AND r.k = 1 WHERE c.k = 1),
done AS (
  SELECT call_id, turn AS t, CAST(0 AS BIGINT) AS d,
    CASE WHEN result_turn IS NULL OR turn >= result_turn THEN turn ELSE result_turn END AS end_t, CAST(CASE WHEN turn >= result_turn THEN 1 ELSE 0 END AS BIGINT) AS end_d
  FROM nodes WHERE need IS NULL
  UNION ALL
  SELECT call_id, t, d, CASE WHEN result_turn IS NULL OR t >= result_turn THEN t ELSE result_turn END, CASE WHEN result_turn IS NULL THEN d WHEN t >= result_turn THEN d + 1 ELSE 0 END
  FROM (
    SELECT n.call_id, n.result_turn, CASE WHEN end_t >= n.turn THEN end_t ELSE n.turn END AS t, CASE WHEN end_t >= n.turn THEN end_d + 1 ELSE 0 END AS d
    FROM nodes n JOIN done ON n.need = done.call_id
  )
),
placed AS (SELECT n.*, coalesce(t, turn) AS t, coalesce(d, 0) AS d, t IS NULL AS blocked FROM nodes n LEFT JOIN done USING (call_id))
SELECT c.conv_id, c.turn, 'call' AS kind, c.call_id, CASE WHEN c.k = 1 THEN p.result_turn END AS partner_turn,
  CASE WHEN c.k > 1 THEN 'duplicate' WHEN errors <> '' THEN 'invalid' WHEN p.blocked THEN 'blocked' WHEN p.result_turn IS NULL THEN 'unanswered' ELSE 'linked' END AS status,
  errors, CASE WHEN c.k = 1 THEN p.t ELSE c.turn END AS order_turn, CASE WHEN c.k = 1 THEN p.d ELSE 0 END AS order_depth,
  json_object('arguments', arguments, 'id', c.call_id, 'name', 'answer', 'type', 'tool_call')::VARCHAR AS json
FROM ranked_calls c JOIN placed p USING (call_id)
UNION ALL
SELECT r.conv_id, r.turn, 'result', r.call_id, CASE WHEN r.k = 1 THEN p.turn END, CASE WHEN p.call_id IS NULL THEN 'orphan' WHEN r.k > 1 THEN 'duplicate' ELSE 'linked' END, '',
  CASE WHEN p.t >= r.turn THEN p.t ELSE r.turn END, CASE WHEN p.t >= r.turn THEN p.d + 1 ELSE 0 END,
  json_object('content', r.text, 'id', r.call_id, 'type', 'tool_result')::VARCHAR
FROM ranked_results r LEFT JOIN placed p USING (call_id)
UNION ALL
SELECT conv_id, turn, 'message', NULL, NULL, 'plain', '', turn, 0, json_object('content', text, 'role', role, 'type', 'message')::VARCHAR
FROM m WHERE coalesce(role, '') NOT IN ('user', 'assistant')
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_url_filter, op2_ngram_join, op3_bpe, op4_warc, op5_decontaminate, op6_chat, op7_quality, op8_mpegts, op9_token_counts, op10_suffix_dedup)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op4_warc": OP4_SQL, "op6_chat": OP6_SQL}

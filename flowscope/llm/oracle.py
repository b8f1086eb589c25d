"""DuckDB SQL of the registered queries that SQL can express."""

from flowscope.llm.oracle_secrets import SECRETS

# a word of a text, after lower-casing A-Z
LOWERED = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")

ORACLE: dict[str, str] = {}

ORACLE["op1_decontaminate"] = rf"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), bw AS (
  SELECT item_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bg AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
         array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM bw, unnest(range(1, greatest(len(w) - 10, 0) + 2)) t(i) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT n FROM bg),
dg AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM dw, sizes, unnest(range(1, len(w) - n + 2)) t(i) WHERE len(w) >= n
), hits AS (
  SELECT dg.doc_id, dg.i, dg.n, bg.item_id FROM dg JOIN bg ON dg.n = bg.n AND dg.g = bg.g
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) t(p) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY doc_id
)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_ESCAPED = (r"replace(replace(replace(replace({x}, '\', '\0'), '<', '\1'), '[', '\2'), ']', '\3')")
ORACLE["op5_chat_format"] = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM t
), g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY k) AS told,
         coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '') AS loss,
         7 + sum(length({_ESCAPED.format(x='text')})
             + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 13 WHEN 'system' THEN 13
               ELSE 16 + length({_ESCAPED.format(x='role')}) END) AS formatted_chars
  FROM o GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM g
"""

ORACLE["op7_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256 FROM documents
), g AS (
  SELECT *, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id,
         row_number() OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS k
  FROM d
)
SELECT doc_id, keep_id, group_size, k = 1 AS kept, text_sha256 FROM g
"""

ORACLE["op11_secrets"] = SECRETS

ORACLE["op13_fill_in_middle"] = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS x, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), u AS (
  SELECT doc_id, x, n,
         CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS c1, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS c2,
         CASE WHEN n = 0 OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>')
                   OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
              WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d
), c AS (SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b FROM u)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN x
              WHEN 'psm' THEN '<P>' || substr(x, 1, a) || '<S>' || substr(x, b + 1) || '<M>' || substr(x, a + 1, b - a)
              ELSE '<S>' || substr(x, b + 1) || '<P>' || substr(x, 1, a) || '<M>' || substr(x, a + 1, b - a) END)
         AS output_sha256,
       sha256(x) AS restored_sha256
FROM c
"""

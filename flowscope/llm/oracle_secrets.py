"""DuckDB SQL of the secret scan, from the same tables of patterns: every window's counts are taken anew."""

from __future__ import annotations

import math
import re

from flowscope.llm.secrets import ALLOW, BASE_KINDS, CLASSES, UNIT, WINDOW


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _either_case(pattern: str) -> str:
    """``(?i)`` spelled out for the letters A to Z (DuckDB's flag folds other letters too)."""
    if not pattern.startswith("(?i)"):
        return pattern
    named, rest = pattern[4:].split(")", 1)
    return re.sub(r"[a-z]", lambda m: f"[{m.group().upper()}{m.group()}]", named) + ")" + rest


def _matches(kind: str, k: int, pattern: str, group: int) -> str:
    p = _quoted(_either_case(pattern))
    return f"""
  SELECT r, {k} AS k, '{kind}' AS kind, hit, CAST(sum(length(gap) + length(whole)) OVER w AS INT) - length(whole) AS s,
         CAST(sum(length(gap) + length(whole)) OVER w AS INT) AS e
  FROM (SELECT r, unnest(regexp_extract_all(x, {p})) AS whole, unnest(regexp_extract_all(x, {p}, {group})) AS hit,
               unnest(string_split_regex(x, {p})[:len(regexp_extract_all(x, {p}))]) AS gap,
               unnest(range(len(regexp_extract_all(x, {p})))) AS i FROM t)
  WINDOW w AS (PARTITION BY r ORDER BY i)"""


_BASE = " UNION ALL ".join(
    f"SELECT r, k, kind, s, e FROM ({_matches(kind, k, p, g)}) WHERE length(hit) >= {n}"
    for k, (kind, p, g, n, _) in enumerate(BASE_KINDS))
_COST = "[" + ", ".join(str(round(c * math.log2(c) * UNIT) if c else 0) for c in range(WINDOW + 1)) + "]"
_ALLOWED = " OR ".join(f"regexp_matches(hit, {_quoted(p)})" for p in ALLOW)
_FOUND = " UNION ALL ".join(f"""
  SELECT r, k, kind, min(pos) AS s, max(pos) + {WINDOW} AS e
  FROM (SELECT *, sum(CASE WHEN pos <= before + {WINDOW} THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY pos) AS part
        FROM (SELECT *, lag(pos) OVER (PARTITION BY r ORDER BY pos) AS before
              FROM (SELECT r, k, kind, s + i AS pos, list_aggregate(string_split(substr(hit, i + 1, {WINDOW}), ''), 'histogram') AS h
                    FROM ({_matches(c.kind, k, c.pattern, 0)}), unnest(range(length(hit) - {WINDOW - 1})) u(i)
                    WHERE NOT ({_ALLOWED}))
              WHERE list_sum(list_transform(map_values(h), lambda n: ({_COST})[CAST(n AS BIGINT) + 1])) <= {c.bound}))
  GROUP BY r, k, kind, part""" for k, c in enumerate(CLASSES, len(BASE_KINDS)))

SECRETS = f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS x FROM documents),
base AS ({_BASE}),
extra AS (SELECT * FROM ({_FOUND}) f
          WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.r = f.r AND b.s <= f.s AND f.e <= b.e)),
b AS (SELECT r, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS told,
             {", ".join(f"count(*) FILTER (kind = '{kind}') AS n_{kind}" for kind, *_ in BASE_KINDS)}
      FROM base GROUP BY r),
a AS (SELECT r, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans
      FROM (SELECT * FROM base UNION ALL SELECT * FROM extra) GROUP BY r)
SELECT doc_id, {", ".join(f"CAST(coalesce(n_{kind}, 0) AS BIGINT) AS n_{kind}" for kind, *_ in BASE_KINDS)},
       sha256(coalesce(told, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN b USING (r) LEFT JOIN a USING (r)
"""

"""SQL twins of the queries on conversations and manifests."""

from __future__ import annotations

from .merkle import LOWER, UPPER


def crc32(text: str) -> str:
    """Unsigned checksum of an SQL text expression over ASCII characters, bit by bit."""
    codes = f"list_transform(string_split({text}, ''), lambda x: unicode(x)::BIGINT)"
    step = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda c, b: {step}), 4294967295)"


def told(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"


def leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(told, ("doc_id", "source", "lang", "n_chars", text))) + ")"


OP12 = f"""
WITH RECURSIVE texts AS (SELECT *, CASE WHEN {crc32("doc_id::VARCHAR")} % 3 = 0 THEN translate(text, '{UPPER}', '{LOWER}') ELSE text END AS now FROM documents),
leaves AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, row_number() OVER () AS id
  FROM (SELECT doc_id, lang, {leaf("text")} AS leaf, {leaf("now")} AS now FROM texts)),
tree AS (
  SELECT lang, 0 AS l, i, leaf AS d, count(*) OVER (PARTITION BY lang) AS n FROM leaves
  UNION ALL
  SELECT lang, l + 1, i // 8, sha256(string_agg(d, '' ORDER BY i)), any_value((n + 7) // 8) FROM tree WHERE n > 1 GROUP BY lang, l, i // 8
),
subroots AS MATERIALIZED (SELECT lang, d, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1),
upper_tree AS (
  SELECT 0 AS l, i, d, n FROM subroots
  UNION ALL
  SELECT l + 1, i // 8, sha256(string_agg(d, '' ORDER BY i)), any_value((n + 7) // 8) FROM upper_tree WHERE n > 1 GROUP BY l, i // 8
),
depth AS (SELECT lang, max(l) AS levels FROM tree GROUP BY lang),
runs AS MATERIALIZED (  -- every run of every level, the upper tree's levels above those of the language
  SELECT lang, l, i // 8 AS run, list(d ORDER BY i) AS ds FROM tree WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT s.lang, d.levels + u.l, u.i // 8, list(u.d ORDER BY u.i) FROM subroots s JOIN depth d ON d.lang IS NOT DISTINCT FROM s.lang
  JOIN upper_tree u ON u.n > 1 AND u.i // 8 = s.i // (8 * (8 ** u.l)::BIGINT) GROUP BY ALL
),
walk AS (
  SELECT id, v.lang, 0 AS l, CASE WHEN levels = 0 THEN s.i ELSE v.i END AS i, now AS d, '' AS others
  FROM leaves v JOIN depth ON depth.lang IS NOT DISTINCT FROM v.lang JOIN subroots s ON s.lang IS NOT DISTINCT FROM v.lang
  UNION ALL
  SELECT w.id, w.lang, w.l + 1, CASE WHEN w.l + 1 = levels THEN s.i ELSE w.i // 8 END,
    sha256(array_to_string(r.ds[:w.i % 8] || [w.d] || r.ds[w.i % 8 + 2:], '')), w.others || array_to_string(r.ds[:w.i % 8] || r.ds[w.i % 8 + 2:], '')
  FROM walk w JOIN depth ON depth.lang IS NOT DISTINCT FROM w.lang JOIN subroots s ON s.lang IS NOT DISTINCT FROM w.lang
  JOIN runs r ON r.lang IS NOT DISTINCT FROM w.lang AND r.l = w.l AND r.run = w.i // 8
),
ends AS (SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY id ORDER BY l DESC) = 1)
SELECT v.doc_id, v.leaf, s.d AS subroot, u.d AS root, sha256(e.others) AS proof_sha256, e.d AS folded_root, e.d = u.d AS verified
FROM leaves v JOIN ends e USING (id) JOIN subroots s ON s.lang IS NOT DISTINCT FROM v.lang JOIN (SELECT d FROM upper_tree WHERE n = 1) u ON true
"""

_SPACE = r"[\x20\x09-\x0D]"
_ID = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"

#: Edits of one row, and insertions before it: state, state after, kind, edits, cost, roles inserted before.
_MOVES = """
due(state, role, dest) AS (VALUES (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)),
inserted AS (
  SELECT state, state AS mid, '' AS edits, 0 AS cost, []::VARCHAR[] AS roles FROM due
  UNION ALL SELECT state, dest, 'I', 5, [role || ':'] FROM due
  UNION ALL SELECT a.state, b.dest, 'II', 10, [a.role || ':', b.role || ':'] FROM due a JOIN due b ON b.state = a.dest
),
moves AS (
  SELECT i.state, i.mid AS dest, 'D' AS kind, i.edits || 'D' AS edits, i.cost + 2 AS cost, i.roles, NULL AS role FROM inserted i
  UNION ALL SELECT i.state, d.dest, 'R', i.edits || 'R', i.cost + 1, i.roles, d.role FROM inserted i JOIN due d ON d.state = i.mid
  UNION ALL SELECT i.state, d.dest, d.role[1], i.edits || 'K', i.cost, i.roles, NULL FROM inserted i JOIN due d ON d.state = i.mid
  UNION ALL SELECT i.state, 1, 's', i.edits || 'K', i.cost, i.roles, NULL FROM inserted i WHERE i.mid = 0
)"""

OP11 = f"""
WITH RECURSIVE {_MOVES},
fated AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32(_ID)} % 20 AS fate FROM conversations
),
harmed AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role, CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy
  FROM fated WHERE fate <> 0
),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p FROM harmed),
faulty AS (
  SELECT *, regexp_replace(text, '{_SPACE}+$', '') AS body, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) AS nth,
    lag(role[1]) OVER (PARTITION BY conv_id ORDER BY p) || role[1] AS pair FROM placed
),
turns AS MATERIALIZED (
  SELECT *, body = '' AS blank, body <> '' AND nth > 1 AS duplicate, body <> '' AND nth = 1 AND body[-1] NOT IN ('.', '!', '?') AS truncated,
    coalesce(pair NOT IN ('su', 'ua', 'au'), false) AS illegal FROM faulty
),
walk AS (
  SELECT DISTINCT conv_id, 0 AS p, 0 AS state, 0 AS cost, '' AS audit, []::VARCHAR[] AS repaired FROM conversations
  UNION ALL
  SELECT conv_id, p, dest, best.cost, best.audit, best.repaired FROM (
    SELECT w.conv_id, t.p, m.dest, min({{'cost': w.cost + m.cost + CASE WHEN t.truncated AND m.kind <> 'D' THEN 5 ELSE 0 END, 'audit': w.audit || m.edits,
      'repaired': w.repaired || m.roles || CASE WHEN m.kind = 'D' THEN [] ELSE [coalesce(m.role, t.role) || ':' || t.text] END}}) AS best
    FROM walk w JOIN turns t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.p = w.p + 1
    JOIN moves m ON m.state = w.state AND (m.kind = 'D' OR NOT (t.blank OR t.duplicate) AND (m.kind = 'R' OR m.kind = t.role[1]))
    GROUP BY w.conv_id, t.p, m.dest
  )
),
ended AS (
  SELECT w.conv_id, min({{'cost': w.cost + i.cost, 'audit': w.audit || i.edits, 'repaired': w.repaired || i.roles}}) AS best
  FROM (SELECT * FROM walk QUALIFY p = max(p) OVER (PARTITION BY conv_id)) w JOIN inserted i ON i.state = w.state AND i.mid IN (0, 3) GROUP BY w.conv_id
),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
    count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal FROM turns GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, best.cost::BIGINT AS cost, best.audit AS audit, sha256(array_to_string(best.repaired, chr(10))) AS repaired_sha256
FROM ended e LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""

"""DuckDB SQL of the operator queries that SQL can state."""

from __future__ import annotations

OP1 = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
  FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm)
"""

OP5 = r"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS body FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, body)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, body) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<turn:' || role || '>' || body || '</turn>') + 1) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

# Linked pairs come from counting shared shingles; components by walking the links.
OP9 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 3 THEN array_to_string(ws, ' ')
    ELSE array_to_string(ws[i:i + 2], ' ') END AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM s x JOIN s y ON x.g = y.g AND x.doc_id != y.doc_id GROUP BY ALL),
l AS (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * c >= 90 * (na.n + nb.n - c)),
r(doc_id, reach) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.reach = l.a)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.reach) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""

# Phrases as lists of words; a list's text joined by spaces is unique, as words hold no space.
OP12 = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, ws[i:i + k - 1] AS q
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) AS s(k)
        WHERE len(ws) >= k)),
f AS MATERIALIZED (SELECT lang, phrase, any_value(k) AS k, any_value(q) AS q, count(*) AS c FROM g GROUP BY lang, phrase),
n AS (SELECT lang, CAST(sum(c) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT * FROM f WHERE k > 1 AND c >= 30),
cut AS (
  SELECT lang, phrase, k, a, l, r, j, CAST((2000000::HUGEINT * a) // (l + r) AS BIGINT) AS score
  FROM (SELECT lang, phrase, k, c AS a, unnest(range(1, k)) AS j,
          unnest([array_to_string(q[1:x], ' ') FOR x IN range(1, k)]) AS first,
          unnest([array_to_string(q[x + 1:k], ' ') FOR x IN range(1, k)]) AS rest FROM c) c
  JOIN (SELECT lang || chr(31) || phrase AS at, c AS l FROM f) x ON x.at = c.lang || chr(31) || first
  JOIN (SELECT lang || chr(31) || phrase AS at, c AS r FROM f) y ON y.at = c.lang || chr(31) || rest),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS o FROM cut) WHERE o = 1),
inside AS (
  SELECT lang, array_to_string(q[i:i + s - 1], ' ') AS phrase, max(c) AS around
  FROM (SELECT *, unnest(range(1, k - s + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS s FROM c))
  GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
  WHERE i.around IS NULL OR 100 * i.around < 80 * b.a)
SELECT * FROM (
  SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, encode(k.phrase)) AS rank,
    k.phrase, a, l, r, n.n, score FROM kept k JOIN n ON n.lang = k.lang) WHERE rank <= 2000
"""

ORACLE: dict[str, str] = {
    "op1_exact_dedup": OP1,
    "op5_chat_formatting": OP5,
    "op9_jaccard_join": OP9,
    "op12_phrase_collocations": OP12,
}

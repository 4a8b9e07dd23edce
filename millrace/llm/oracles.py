"""The SQL that gives the same rows, where SQL can. Written apart from the operators; only word lists are shared."""

from __future__ import annotations

from millrace.llm.licences import DIGESTS, KNOWN, SPELLINGS

OP3 = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), m AS (
  SELECT payload_digest, max(page_id) AS original FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN original IS NOT NULL AND page_id <> original THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> original THEN original END AS refers_to
FROM p LEFT JOIN m USING (payload_digest)
"""

OP5 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM r WHERE place <= 20
"""

OP7 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *, length(role) + length(text)
    + length(regexp_replace(role || text, '[^<>\\]', '', 'g')) + length('<turn:></turn>') AS chars
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _op8() -> str:
    spelt = "' ' || line || ' '"
    for a, b in SPELLINGS:
        spelt = f"replace({spelt}, ' {a} ', ' {b} ')"
    known = ", ".join(f"({n}, {_text(name)}, {_text(text)})" for n, (name, text) in enumerate(KNOWN))
    more = ", ".join(f"({len(KNOWN) + n}, {_text(name)}, {_text(value)})" for n, (name, value) in enumerate(DIGESTS))
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
WITH given AS (SELECT * FROM (VALUES {known}) AS k(place, licence, text)),
texts AS (
  SELECT 1 AS kind, doc_id AS id, doc_id, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT 2, place, NULL, text FROM given
), cut AS (
  SELECT kind, id, doc_id, unnest(string_split(regexp_replace(
      replace(replace(translate(text, chr(13) || '{capitals}', chr(10) || '{capitals.lower()}'), '(c)', 'copyright'), '©', 'copyright'),
      '[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), chr(10))) AS line,
    generate_subscripts(string_split(translate(text, chr(13), chr(10)), chr(10)), 1) AS raw
  FROM texts
), kept AS (
  SELECT kind, id, doc_id, raw, trim(line, ' ') AS line FROM cut
  WHERE trim(line, ' ') <> '' AND NOT regexp_matches(trim(line, ' '), '^(copyright (copyright|[0-9]{{4}})|copyright( [^ ]+){{1,8}} [12][0-9]{{3}}( present)?$|all rights reserved$)')
), spelt AS (
  SELECT kind, id, doc_id, row_number() OVER (PARTITION BY kind, id ORDER BY raw) AS line_no, trim({spelt}, ' ') AS line FROM kept
), whole AS (
  SELECT t.kind, t.id, t.doc_id, sha256(coalesce(string_agg(line, ' ' ORDER BY line_no), '')) AS digest
  FROM texts t LEFT JOIN spelt s ON t.kind = s.kind AND t.id = s.id GROUP BY t.kind, t.id, t.doc_id
), known AS (
  SELECT digest AS known_digest, min_by(licence, place) AS licence FROM (
    SELECT digest, licence, place FROM whole JOIN given ON kind = 2 AND id = place
    UNION ALL SELECT digest, licence, place FROM (VALUES {more}) AS k(place, licence, digest)
  ) GROUP BY digest
)
SELECT doc_id, 'text' AS unit, CAST(0 AS INTEGER) AS line, digest, licence FROM whole LEFT JOIN known ON digest = known_digest WHERE kind = 1
UNION ALL
SELECT doc_id, 'line', CAST(line_no AS INTEGER), sha256(line), licence FROM spelt JOIN known ON sha256(line) = known_digest WHERE kind = 1
"""


OP8 = _op8()

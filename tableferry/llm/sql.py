"""The queries that SQL can express, as SQL."""

from __future__ import annotations

from tableferry.llm.quality import BASE, POLICIES, RULES, SYMBOLS, mask

#: White space that parts words, for the SQL engine's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"

_BITS = " + ".join(
    f"(CASE WHEN {rule.condition} THEN {1 << place} ELSE 0 END)" for place, rule in enumerate(RULES)
)

QUALITY = f"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{WORD}')) AS lines
  FROM documents),
windows AS (
  SELECT r, i, [w[i], w[i + 1], w[i + 2]] AS x
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
repeated AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT r, count(DISTINCT p) AS n
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM repeated) GROUP BY r),
measured AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^{SYMBOLS}]+', '', 'g'))::BIGINT AS n_symbols,
         len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM words LEFT JOIN covered USING (r)),
ledger AS (SELECT *, ({_BITS})::BIGINT AS failed_bits FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failed_bits & {mask(BASE)}) <> 0 AS base_failed,
       (failed_bits & {mask(POLICIES["v1"]) | mask(BASE)}) = 0 AS kept, n_lines, failed_bits
FROM ledger
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DUPS = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{WORD}') AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
                               ELSE array_to_string(w[i:i + 4], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.doc_id, edges.b FROM reach JOIN edges ON edges.a = reach.other)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT doc_id, min(other) AS c FROM reach GROUP BY doc_id) m ON m.doc_id = d.doc_id
"""

HARD_NEGATIVES = """
WITH rows AS (
  SELECT row_number() OVER () AS r, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike,
         CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.r <> b.r WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor, anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS w
  FROM scored WHERE alike QUALIFY w <= 5),
negatives AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score,
         s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor, p.w ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM positives p JOIN scored s ON s.anchor = p.anchor AND NOT s.alike
    AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT * FROM negatives WHERE rank <= 3
"""

ORACLE: dict[str, str] = {
    "op12_hard_negatives": HARD_NEGATIVES,
    "op1_near_dups": NEAR_DUPS,
    "op9_quality_ledger": QUALITY,
}

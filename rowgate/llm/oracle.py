"""DuckDB SQL for the operators that SQL can express.

The others (learned scores, approximate search, hashed draws, tokenizers, files)
are tested against the libraries or plain versions in ``tests/llm``.
"""

from __future__ import annotations

LINE_FREQUENCY = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
texts AS (SELECT DISTINCT source, t, ws FROM d),
lines AS (
  SELECT source, t, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
         trim(regexp_replace(regexp_replace(lower(line), '\p{Nd}', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
  FROM (SELECT source, t, unnest(string_split(t, chr(10))) AS line FROM texts)),
worded AS (SELECT * FROM lines WHERE words > 0),
hosts AS (SELECT source, count(*) AS docs FROM texts GROUP BY source),
frequent AS (
  SELECT w.source, w.norm FROM (SELECT source, norm, count(DISTINCT t) AS n FROM worded GROUP BY source, norm) w
  JOIN hosts h ON w.source IS NOT DISTINCT FROM h.source WHERE w.n > 20 AND w.n > h.docs * 0.05),
removed AS (
  SELECT w.source, w.t, count(*) AS n_lines, sum(w.words) AS n_words FROM worded w
  JOIN frequent f ON w.source IS NOT DISTINCT FROM f.source AND w.norm = f.norm GROUP BY w.source, w.t),
repeated_lines AS (SELECT source, t, count(*) - count(DISTINCT line) AS n FROM worded GROUP BY source, t),
windows AS (
  SELECT source, t, i, array_to_string(list_slice(ws, i, i + 4), ' ') AS x
  FROM (SELECT source, t, ws, unnest(generate_series(1, len(ws) - 4)) AS i FROM texts WHERE len(ws) >= 5)),
twice AS (SELECT source, t, i FROM (SELECT *, count(*) OVER (PARTITION BY source, t, x) AS n FROM windows) WHERE n > 1),
repeats AS (
  SELECT source, t, count(DISTINCT p) AS n
  FROM (SELECT source, t, unnest(generate_series(i, i + 4)) AS p FROM twice) GROUP BY source, t),
base AS (
  SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(d.ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(d.t) - length(regexp_replace(d.t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(l.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(p.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(r.n_lines, 0) AS BIGINT) AS n_removed_lines, CAST(coalesce(r.n_words, 0) AS BIGINT) AS n_removed_words
  FROM d LEFT JOIN repeated_lines l ON d.source IS NOT DISTINCT FROM l.source AND d.t = l.t
  LEFT JOIN repeats p ON d.source IS NOT DISTINCT FROM p.source AND d.t = p.t
  LEFT JOIN removed r ON d.source IS NOT DISTINCT FROM r.source AND d.t = r.t),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         n_removed_words > 0 AND (n_words - n_removed_words < 10 OR n_words - n_removed_words < n_words * 0.5) AS depleted
  FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT depleted AS kept,
       n_removed_lines, n_removed_words, depleted FROM judged
"""

RLZ_DEDUP = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 19), ' ') AS x
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 19)) AS i FROM d WHERE len(ws) >= 20)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY x ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1),
covered AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS p FROM later),
words AS (SELECT doc_id, unnest(generate_series(1, len(ws))) AS p, unnest(ws) AS w FROM d WHERE len(ws) > 0),
kept AS (
  SELECT doc_id, string_agg(w, ' ' ORDER BY p) AS t, count(*) AS n
  FROM words ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(len(d.ws) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM d LEFT JOIN kept k USING (doc_id)
"""

KRONECKER_NEGATIVES = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, o.vec_id, a.label = o.label AS same, CAST(list_dot_product(a.x, o.x) AS BIGINT) AS score
  FROM v a JOIN v o ON a.vec_id <> o.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
WHERE 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""

ITQ_DEDUP = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.x, b.x) >= 0.95),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = e.vec_id
LEFT JOIN degree d ON d.a = e.vec_id
"""

FILTER_AUDIT = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
firsts AS (SELECT t, min(doc_id) AS first FROM d GROUP BY t),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY doc_id),
fails AS (
  SELECT part, coalesce(good, 0) = 1 AS good, coalesce(toxic, 0) = 1 AS toxic,
         (CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END)
         || (CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END)
         || (CASE WHEN 100 * (length(d.t) - length(regexp_replace(d.t, '[A-Z]', '', 'g'))) > 2 * length(d.t) THEN 'C' ELSE '' END)
         || (CASE WHEN regexp_matches(d.t, '[#$%&*|]') THEN 'D' ELSE '' END)
         || (CASE WHEN d.doc_id > f.first THEN 'E' ELSE '' END) AS f
  FROM d JOIN firsts f ON d.t = f.t LEFT JOIN l ON l.doc_id = d.doc_id),
cells AS (SELECT part, f, good, toxic, count(*) AS n FROM fails GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT o, s, o[s] AS x, o[:s - 1] AS before FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS s)),
counts AS (
  SELECT c.part, s.o AS filter_order, s.s AS step, s.x,
         sum(CASE WHEN translate(c.f, s.before || s.x, '') = c.f THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN contains(c.f, s.x) AND translate(c.f, s.before, '') = c.f THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN contains(c.f, s.x) AND translate(c.f, s.before, '') <> c.f THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN c.f = s.x THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN c.good AND contains(c.f, s.x) AND translate(c.f, s.before, '') = c.f THEN n ELSE 0 END) AS good_lost,
         sum(CASE WHEN c.toxic AND contains(c.f, s.x) AND translate(c.f, s.before, '') = c.f THEN n ELSE 0 END) AS toxic_lost
  FROM cells c, steps s GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM counts
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_line_frequency": LINE_FREQUENCY, "op2_rlz_dedup": RLZ_DEDUP, "op11_kronecker_negatives": KRONECKER_NEGATIVES,
            "op12_itq_dedup": ITQ_DEDUP, "op13_filter_audit": FILTER_AUDIT}

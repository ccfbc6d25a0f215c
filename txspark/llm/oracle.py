"""The results of those queries that SQL can express, for another engine."""

from __future__ import annotations

_REACH = """
reach AS (
  SELECT id, id AS other FROM nodes
  UNION
  SELECT reach.id, both_ways.b FROM reach JOIN both_ways ON reach.other = both_ways.a
),
roots AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
"""

NGRAM_JACCARD_JOIN = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g
  FROM words
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
  FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2
),
links AS (
  SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)
),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
nodes AS (SELECT doc_id AS id FROM documents),
{_REACH}
SELECT roots.id AS doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM roots LEFT JOIN sizes ON sizes.doc_id = roots.id
"""

COVER_TREE_DEDUP = f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
both_ways AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x, vectors y
  WHERE x.vec_id <> y.vec_id AND CASE WHEN len(x.v) = len(y.v) THEN list_cosine_similarity(x.v, y.v) >= 0.9 ELSE false END
),
nodes AS (SELECT vec_id AS id FROM embeddings),
{_REACH},
counts AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT id AS vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, id = component_id AS kept
FROM roots LEFT JOIN counts ON a = id
"""

# The words and limits of the quality rules, spelled out once more.
_COMMON = "a as auf con das de del den der des die du el en est et for in is ist la las le les los mit of que se that the to un und une von was with y zu and".split()
_COMMON_SQL = "[" + ", ".join(f"'{w}'" for w in sorted(_COMMON)) + "]"


def _divergence(counts: str, reference: str) -> str:
    return (
        f"(SELECT sqrt(greatest(sum("
        f"CASE WHEN p > 0 THEN p * ln(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(2 * q / (p + q)) ELSE 0 END), 0) / (2 * ln(2))) "
        f"FROM (SELECT unnest({counts}) / list_sum({counts}) AS p, unnest({reference}) / list_sum({reference}) AS q))"
    )


QUALITY_RULES = rf"""
WITH split AS (
  SELECT doc_id, lang, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents)
),
windows AS (
  SELECT doc_id, i, ws[i:i + 4] AS w FROM (
    SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1))) AS i FROM split)
),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS c FROM windows) WHERE c > 1),
repeats AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(5) r(k) GROUP BY doc_id),
rest1 AS (SELECT *, regexp_replace(t, '\p{{Ll}}+', '', 'g') AS r1 FROM split),
rest2 AS (SELECT *, regexp_replace(r1, '\p{{Lu}}+', '', 'g') AS r2 FROM rest1),
rest3 AS (SELECT *, regexp_replace(r2, '\p{{N}}+', '', 'g') AS r3 FROM rest2),
rest4 AS (SELECT *, regexp_replace(r3, '\s+', '', 'g') AS r4 FROM rest3),
rest5 AS (SELECT *, regexp_replace(r4, '[.,;:!?''()"-]+', '', 'g') AS r5 FROM rest4),
counted AS (
  SELECT *, [length(t) - length(r1), length(r1) - length(r2), length(r2) - length(r3), length(r3) - length(r4),
      length(r4) - length(r5), length(r5)] AS classes,
    list_transform({_COMMON_SQL}, lambda c: len(list_filter(ws, lambda w: lower(w) = c))) AS seen
  FROM rest5
),
binned AS (SELECT *, list_append(seen, len(ws) - list_sum(seen)) AS bins FROM counted),
class_sums AS (
  SELECT lang, list(n ORDER BY i) AS ref FROM (
    SELECT lang, i, sum(classes[i]) AS n FROM binned, range(1, 7) r(i) WHERE lang IN ('de', 'en', 'es', 'fr') GROUP BY ALL)
  GROUP BY lang
),
word_sums AS (
  SELECT lang, list(n ORDER BY i) AS ref FROM (
    SELECT lang, i, sum(bins[i]) AS n FROM binned, range(1, {len(_COMMON) + 2}) r(i) WHERE lang IN ('de', 'en', 'es', 'fr') GROUP BY ALL)
  GROUP BY lang
),
class_far AS (
  SELECT doc_id, min({_divergence('classes', 'ref')}) AS d FROM binned, class_sums
  WHERE list_sum(classes) >= 200 GROUP BY doc_id
),
word_far AS (
  SELECT doc_id, min({_divergence('bins', 'ref')}) AS d FROM binned, word_sums WHERE len(ws) >= 60 GROUP BY doc_id
),
base AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(repeats.n, 0)::BIGINT AS n_repeat_words
  FROM binned LEFT JOIN repeats USING (doc_id)
)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
    AND NOT coalesce(c.d > 0.32, false) AND NOT coalesce(w.d > 0.17 + 1 / sqrt(n_words), false) AS kept
FROM base LEFT JOIN (SELECT doc_id, d FROM class_far) c USING (doc_id) LEFT JOIN (SELECT doc_id, d FROM word_far) w USING (doc_id)
"""

# Runs by brute force: stretches of 16 words that recur in a text, joined to islands of each distance.
PERIODIC_RUNS = r"""
WITH base AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda r, z: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384::BIGINT) ELSE r // 2 END))) AS h
  FROM documents
),
spots AS (
  SELECT doc_id, ws, len(ws) AS n, doc_id IS NOT NULL AND h % 10 = 0 AND len(ws) > 0 AS moved, (h // 10) % greatest(len(ws), 1) AS a, 3 + (h // 10) % 8 AS k
  FROM base
),
texts AS (
  SELECT doc_id, n, CASE WHEN moved THEN list_transform(range(n),
    lambda i: ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // k) END]) ELSE ws END AS ws
  FROM spots
),
-- a run holds at least 16 words that equal the ones a period further on, so stretches of 16 words recur
stretches AS (
  SELECT doc_id, n, unnest(range(n - 15)) AS i, unnest(list_transform(range(n - 15), lambda j: array_to_string(ws[j + 1:j + 16], ' '))) AS g
  FROM texts WHERE n >= 24
),
again AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM stretches x JOIN stretches y
  ON x.doc_id = y.doc_id AND x.g = y.g AND y.i > x.i AND 3 * (y.i - x.i) <= x.n
),
islands AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM again),
periodic AS (
  SELECT doc_id, q, min(i) AS s, count(*) + 15 + q AS len FROM islands GROUP BY doc_id, q, island
  HAVING count(*) + 15 + q >= greatest(24, 3 * q)
),
runs AS (SELECT doc_id, s, len, min(q) AS q FROM periodic GROUP BY doc_id, s, len),
dropped AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + len)) AS i FROM runs),
gone AS (SELECT doc_id, list(i) AS gone FROM dropped GROUP BY doc_id),
strongest AS (
  SELECT doc_id, s, len, q FROM runs r WHERE NOT EXISTS (
    SELECT 1 FROM runs o WHERE o.doc_id = r.doc_id AND (o.len * r.q > r.len * o.q
      OR o.len * r.q = r.len * o.q AND (o.s < r.s OR o.s = r.s AND o.q < r.q)))
),
told AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS spelled FROM runs GROUP BY doc_id
)
SELECT t.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, s::BIGINT AS "start", len::BIGINT AS "length", q::BIGINT AS "period",
  (1000 * len // q)::BIGINT AS exponent_milli, sha256(coalesce(spelled, '')) AS runs_sha256,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN ws
    ELSE list_filter(ws, lambda x, i: NOT list_contains(gone, i - 1)) END, ' ')) AS collapsed_sha256
FROM texts t LEFT JOIN told ON told.doc_id = t.doc_id LEFT JOIN strongest b ON b.doc_id = t.doc_id LEFT JOIN gone ON gone.doc_id = t.doc_id
"""


def oracle_sql() -> dict[str, str]:
    columns = "doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept"
    return {
        "op3_quality_rules": f"SELECT {columns} FROM ({QUALITY_RULES})",
        "op6_ngram_jaccard_join": NGRAM_JACCARD_JOIN,
        "op7_cover_tree_dedup": COVER_TREE_DEDUP,
        "op13_periodic_runs": PERIODIC_RUNS,
    }

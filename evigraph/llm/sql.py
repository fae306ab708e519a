"""SQL counterparts of the operators that SQL can express (DuckDB)."""

from __future__ import annotations

from .secret_scan import RULES

EXACT_DEDUP = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id)
"""


def _rule_sql(rank: int, rule) -> str:
    quoted, group = (rule.plain or rule.pattern).replace("'", "''"), 1 if rule.plain else rule.group
    before, w = ("length(w) - length(g)", "g") if rule.plain else ("0", "w")
    return f"""
  SELECT doc_id, '{rule.kind}' AS kind, {rank} AS rank, {rule.base} AS base, {w} AS w, g,
         {before} + list_sum(list_transform(p[1:i], lambda x: length(x)))::BIGINT + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)::BIGINT AS first
  FROM (SELECT doc_id, p, m, unnest(range(1, len(m) + 1)) AS i, unnest(m) AS w, unnest(gs) AS g
        FROM (SELECT doc_id, regexp_split_to_array(text, '{quoted}') AS p,
                     regexp_extract_all(text, '{quoted}') AS m, regexp_extract_all(text, '{quoted}', {group}) AS gs FROM t))
  WHERE length(g) >= {rule.least}"""


SECRET_SCAN = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
hits AS ({" UNION ALL ".join(_rule_sql(i, r) for i, r in enumerate(RULES))}),
said AS (SELECT *, kind || ':' || first || ':' || (first + length(w)) AS span FROM hits),
by_doc AS (
  SELECT doc_id, {", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in RULES if r.base)},
         coalesce(string_agg(span, ',' ORDER BY first, rank) FILTER (WHERE base), '') AS base_spans,
         coalesce(string_agg(span, ',' ORDER BY first, rank), '') AS spans
  FROM said GROUP BY doc_id)
SELECT t.doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in RULES if r.base)},
       sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN by_doc USING (doc_id)
"""

DIVERGENCE = r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
groups AS (SELECT DISTINCT lang, source FROM d),
w AS (SELECT row, lang, source, term, count(*) AS n FROM (SELECT row, lang, source, unnest(words) AS term FROM d) GROUP BY ALL),
kept AS (SELECT lang, term, sum(n)::HUGEINT AS lang_n FROM w GROUP BY ALL HAVING count(*) >= 10),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(lang_n)::HUGEINT AS total FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, sum(n)::HUGEINT AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM groups LEFT JOIN counts USING (lang, source) GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, (1 + 1000000000 * (coalesce(c.n, 0) + 2) // (g.total + 2 * l.v))::HUGEINT AS p,
             (1 + 1000000000 * (k.lang_n + 2) // (l.total + 2 * l.v))::HUGEINT AS q
      FROM sizes g JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pair_sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
              FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0)::BIGINT AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pair_sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM p WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INT AS rank FROM pairs
UNION ALL
SELECT * FROM (SELECT lang, source, 'term' AS part, item, value, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INT AS rank FROM terms) WHERE rank <= 10
"""

HARD_NEGATIVES = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, e.vec_id, a.label = e.label AS same, list_dot_product(a.vec, e.vec)::BIGINT AS score
           FROM e a JOIN e ON len(a.vec) = len(e.vec) WHERE a.vec_id % 100 = 0 AND a.vec_id <> e.vec_id),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

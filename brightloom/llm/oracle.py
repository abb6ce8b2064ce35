"""Comparison SQL (DuckDB) of the queries that SQL can express on whole tables."""

from __future__ import annotations

#: words of [0-9a-z] and all characters from U+0080, with A-Z lower-cased
_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

DECONTAMINATE = f"""WITH d AS MATERIALIZED (SELECT doc_id, {_WORDS} AS w FROM documents), b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
 starts AS (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM b WHERE len(w) > 0),
 phrase AS MATERIALIZED (SELECT DISTINCT item_id, array_to_string(w[i : i + 9], ' ') AS p, least(len(w), 10) AS n FROM starts),
 sizes AS (SELECT DISTINCT n FROM phrase),
 place AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n),
 hit AS MATERIALIZED (SELECT h.doc_id, h.i, h.n, p.item_id FROM (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS p FROM place) h JOIN phrase p ON h.p = p.p AND h.n = p.n),
 words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hit) t GROUP BY 1),
 items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit WHERE item_id IS NOT NULL) t GROUP BY 1),
 ends AS (SELECT DISTINCT doc_id, i, i + n AS e FROM hit), reach AS (SELECT doc_id, i, e, max(e) OVER (PARTITION BY doc_id ORDER BY i, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM ends),
 spans AS (SELECT doc_id, count(*) FILTER (before IS NULL OR i > before) AS n_spans FROM reach GROUP BY 1)
 SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
 sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans
 FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN spans USING (doc_id)"""


MIX = """WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, source AS src, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
 per AS (SELECT src, CAST(sum(size) AS BIGINT) AS s, 1 + (row_number() OVER (ORDER BY src NULLS LAST) - 1) % 3 AS w, (row_number() OVER (ORDER BY src NULLS LAST) - 1) % 3 AS k FROM w GROUP BY 1),
 q AS (SELECT *, sum(s) OVER () AS total, sum(w) OVER () AS weights, coalesce(sum(3 * s) OVER o, 0) AS cap_before, coalesce(sum(w) OVER o, 0) AS w_before FROM per
 WINDOW o AS (ORDER BY CAST(3 * s AS DOUBLE) / w, src NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
 c AS (SELECT *, 3 * s * (weights - w_before) <= w * (total - cap_before) AS capped FROM q),
 g AS (SELECT *, CAST(total - coalesce(sum(3 * s) FILTER (capped) OVER (), 0) AS DOUBLE) / CAST(nullif(weights - coalesce(sum(w) FILTER (capped) OVER (), 0), 0) AS DOUBLE) AS share FROM c),
 t0 AS MATERIALIZED (SELECT src, s, CASE WHEN capped THEN CAST(3 * s AS DOUBLE) ELSE CAST(w AS DOUBLE) * share END AS target, CASE k WHEN 0 THEN -0.5 WHEN 1 THEN 0.0 ELSE 0.5 END::DOUBLE AS ramp FROM g),
 p0 AS MATERIALIZED (SELECT *, CASE WHEN s > 0 THEN CAST(floor(target / s) AS BIGINT) ELSE 0 END AS passes FROM t0),
 d AS MATERIALIZED (SELECT w.*, target - passes * s AS r1, row_number() OVER o AS rn, coalesce(sum(size) OVER (PARTITION BY w.src ORDER BY cls DESC, h, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2.0::DOUBLE AS middle
 FROM (SELECT w.*, target, passes, s, CASE WHEN size > 0 AND size >= (target - passes * s) / 64 THEN length(bin(size)) - 1 ELSE 0 END AS cls FROM w JOIN p0 ON w.src IS NOT DISTINCT FROM p0.src) w WINDOW o AS (PARTITION BY w.src ORDER BY cls DESC, h, size)),
 walk AS (SELECT src, CAST(0 AS BIGINT) AS rn, target - passes * s AS r, CAST(NULL AS BIGINT) AS doc_id, false AS took FROM p0
 UNION ALL SELECT x.src, x.rn + 1, CASE WHEN size > 0 AND size <= r THEN r - size ELSE r END, d.doc_id, size > 0 AND size <= r FROM walk x JOIN d ON d.src IS NOT DISTINCT FROM x.src AND d.rn = x.rn + 1),
 ends AS (SELECT src, arg_max(r, rn) AS r FROM walk GROUP BY 1),
 least AS (SELECT d.src, d.doc_id, size, e.r FROM d JOIN walk x ON x.src IS NOT DISTINCT FROM d.src AND x.rn = d.rn JOIN ends e ON e.src IS NOT DISTINCT FROM d.src WHERE NOT took AND size > 0 AND e.r > 0
 QUALIFY row_number() OVER (PARTITION BY d.src ORDER BY size, d.rn) = 1),
 last AS (SELECT src, doc_id FROM walk WHERE took UNION ALL SELECT src, doc_id FROM least WHERE size - r < r)
 SELECT doc_id, size, source_size, target, taken, CASE WHEN taken > 0 THEN round(CASE WHEN ramp = 0 THEN u ELSE (sqrt(greatest(0, (1 - ramp) * (1 - ramp) + 4 * ramp * u)) - (1 - ramp)) / (2 * ramp) END, 9) END AS first_position FROM (
 SELECT d.doc_id, d.size, p0.s AS source_size, p0.target, CASE WHEN d.size = 0 THEN 0 ELSE least(3, p0.passes + CASE WHEN l.doc_id IS NULL THEN 0 ELSE 1 END) * d.size END AS taken, ramp,
 least(1.0::DOUBLE, CASE WHEN p0.passes > 0 THEN middle ELSE middle * (p0.target / p0.s) END / p0.target) AS u
 FROM d JOIN p0 ON d.src IS NOT DISTINCT FROM p0.src LEFT JOIN last l ON l.doc_id = d.doc_id AND l.src IS NOT DISTINCT FROM d.src) x"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

COLLOCATIONS = f"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
 words AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
 totals AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM words GROUP BY 1),
 grams AS (SELECT lang, k, w[i : i + k - 1] AS p FROM (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM words, range(1, 6) t(k) WHERE len(w) >= k)),
 f AS MATERIALIZED (SELECT lang, k, p, CAST(count(*) AS HUGEINT) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
 cand AS (SELECT * FROM f WHERE k > 1),
 kept AS (SELECT * FROM cand c WHERE NOT EXISTS (SELECT 1 FROM cand o, range(1, 5) t(i) WHERE o.lang = c.lang AND o.k > c.k AND i <= o.k - c.k + 1 AND o.p[i : i + c.k - 1] = c.p AND 100 * o.a >= 100 * c.a)),
 cuts AS (SELECT c.lang, c.p, c.a, j, l.a AS l, r.a AS r, n, 1000::HUGEINT * c.a * n // (l.a * r.a) AS score FROM kept c JOIN range(1, 5) t(j) ON j < c.k
 JOIN f l ON l.lang = c.lang AND l.p = c.p[1 : j] JOIN f r ON r.lang = c.lang AND r.p = c.p[j + 1 : c.k] JOIN totals ON totals.lang = c.lang),
 best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, j) = 1),
 ranked AS (SELECT *, array_to_string(p, ' ') AS phrase, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank FROM best)
 SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000"""

DIVERGENCE = f"""WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
 groups AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
 t AS (SELECT lang, source, row_number() OVER () AS i, w FROM d), u AS (SELECT lang, source, i, unnest(w) AS term FROM t),
 kept AS MATERIALIZED (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM u GROUP BY 1, 2 HAVING count(DISTINCT i) >= 10),
 sizes AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY 1),
 cells AS MATERIALIZED (SELECT u.lang, source, u.term, CAST(count(*) AS HUGEINT) AS n FROM u JOIN kept k ON u.lang = k.lang AND u.term = k.term GROUP BY 1, 2, 3),
 sums AS (SELECT lang, source, sum(n) AS total FROM cells GROUP BY 1, 2),
 p AS MATERIALIZED (SELECT k.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (coalesce(s.total, 0) + 2 * z.v) AS p, 1 + 1000000000::HUGEINT * (k.n + 2) // (z.total + 2 * z.v) AS q
 FROM kept k JOIN groups g ON g.lang = k.lang JOIN sizes z ON z.lang = k.lang LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source LEFT JOIN cells c ON c.lang = k.lang AND c.source = g.source AND c.term = k.term),
 pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
 every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
 LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
 UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q),
 ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
 SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10"""


SQL = {"op1_decontaminate": DECONTAMINATE, "op7_source_mix": MIX, "op11_collocations": COLLOCATIONS, "op12_divergence": DIVERGENCE}

"""The same results in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x20\x09-\x0D]+"
_SIGN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP3 = rf"""
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{_WORD}')) AS ls
  FROM documents),
g AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
c AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT doc_id, i, unnest(range(5)) AS k FROM r) GROUP BY 1),
m AS (
  SELECT doc_id, source, len(ws)::BIGINT AS n_words, len(array_to_string(ws, ''))::BIGINT AS word_chars,
         len(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN c USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
h AS (
  SELECT source, count(*)::DOUBLE AS n, sum(base_failed::INT)::DOUBLE AS f FROM b
  WHERE source IS NOT NULL GROUP BY 1),
s AS (
  SELECT count(*) AS k, sum(n) AS n, sum(f) AS f, sum(f * f / n) AS ff, sum(n * n) AS nn, sum(f) / sum(n) AS p FROM h),
p AS (
  SELECT p, CASE WHEN p * (1 - p) * (n - nn / n - (k - 1)) > 0 THEN
    1 / least(greatest((ff - f * p - p * (1 - p) * (k - 1)) / (p * (1 - p) * (n - nn / n - (k - 1))), 1e-6), 1.0) - 1
    ELSE 1 END AS weight FROM s),
v AS (SELECT source, round((f + p * weight) / (n + weight), 6) AS host_rate FROM h, p)
SELECT b.doc_id, b.source, word_chars, n_symbols, n_words, n_dup_lines, n_repeat_words, base_failed, host_rate,
       NOT base_failed AND NOT coalesce(host_rate > 0.5, false) AS kept
FROM b LEFT JOIN v ON b.source = v.source
"""

OP5 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '{_WORD}') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (
  SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""

OP7 = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size,
         md5(concat_ws(':', '7', doc_id::VARCHAR)) AS draw FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM d GROUP BY 1),
w AS (SELECT *, [5, 2, 1][(rank % 3 + 1)::INT] AS weight, 2 * source_size AS lim FROM s),
b AS (SELECT 1.5::DOUBLE * sum(source_size) AS budget FROM w),
o AS (
  SELECT *, coalesce(sum(lim) OVER (ORDER BY lim / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
         sum(weight) OVER (ORDER BY lim / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM w),
q AS (SELECT *, lim * open < weight * (budget - held) AS settled FROM o, b),
z AS (
  SELECT budget - coalesce(sum(lim) FILTER (WHERE settled), 0) AS rest,
         greatest(coalesce(sum(weight) FILTER (WHERE NOT settled), 0), 1)::DOUBLE AS open
  FROM q GROUP BY budget),
t AS (
  SELECT source, rank, source_size,
         CASE WHEN settled THEN lim::DOUBLE ELSE weight * z.rest::DOUBLE / z.open END AS target FROM q, z),
c AS (
  SELECT d.*, rank, source_size, target,
         sum(size) OVER (PARTITION BY rank ORDER BY draw, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (
  SELECT doc_id, size, source_size, target, rank, draw, turn,
         (upto + turn * source_size)::DOUBLE / target AS finish FROM c, (SELECT unnest([0, 1]) AS turn)),
f AS (
  SELECT *, sum(size) OVER (ORDER BY finish, rank, turn, draw, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS used
  FROM e)
SELECT doc_id, any_value(size) AS size, any_value(source_size) AS source_size, any_value(target) AS target,
       coalesce(sum(size) FILTER (WHERE used <= budget), 0)::BIGINT AS taken
FROM f, b GROUP BY doc_id
"""

OP10 = rf"""
WITH i AS (
  SELECT item_id, regexp_extract_all({_LOWERED}, '{_SIGN}') AS ws FROM benchmark),
v AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[k:k + n - 1], ' ') AS w
  FROM (SELECT item_id, ws, least(len(ws), 13) AS n, unnest(range(1, len(ws) - least(len(ws), 13) + 2)) AS k
        FROM i WHERE len(ws) > 0)),
d AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '{_SIGN}') AS ws FROM documents),
p AS (
  SELECT doc_id, n, k, array_to_string(ws[k:k + n - 1], ' ') AS w
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS k
        FROM d, (SELECT DISTINCT n FROM v) WHERE len(ws) >= n)),
h AS (SELECT doc_id, p.n, k, item_id FROM p JOIN v ON p.n = v.n AND p.w = v.w),
x AS (SELECT doc_id, count(DISTINCT k + o) AS n_hit FROM (SELECT doc_id, k, unnest(range(n)) AS o FROM h) GROUP BY 1),
y AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM h) GROUP BY 1)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN x USING (doc_id) LEFT JOIN y USING (doc_id)
"""

_HREF = r"""href\s*=\s*["'']?\s*([a-z][a-z0-9+.-]*:)?//[^/?#"''\s<>\\]+"""
_SMALL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _op11(steps: int = 20) -> str:
    """Rules as a table; each step of the propagation is one more subquery."""
    walk = [
        f"""
x{i} AS (
  SELECT kind, dst AS host, sum(floor(rank * 0.85::DOUBLE * pages / wide)::BIGINT)::BIGINT AS rank
  FROM x{i - 1} JOIN e USING (kind, host) GROUP BY 1, 2)"""
        for i in range(1, steps + 1)
    ]
    every = " UNION ALL ".join(f"SELECT * FROM x{i}" for i in range(steps + 1))
    return rf"""
WITH p AS (
  SELECT page_id, html, {_SMALL.format("coalesce(regexp_extract(url, '://([^/?#]*)', 1), '')")} AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path, row_number() OVER () AS nr
  FROM pages),
u(verdict, rule) AS (
  VALUES ('allow', 'org/'), ('block', 'example.org/es/'), ('block', 'example.org/en/1'), ('allow', 'com/fr/'),
         ('block', 'com/de/')),
v AS (
  SELECT nr, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
  FROM p JOIN u ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
               AND starts_with(path, substr(rule, strpos(rule, '/')))
  GROUP BY 1),
r AS (SELECT p.*, rule, verdict FROM p LEFT JOIN v USING (nr)),
k AS (
  SELECT DISTINCT nr, host AS src,
         {_SMALL.format("regexp_extract(h, '//([^/?#]+)', 1)")} AS dst
  FROM (SELECT nr, host, unnest(regexp_extract_all(html, '{_HREF}', 0, 'i')) AS h FROM p)),
g AS (SELECT src, dst, count(*) AS pages FROM k WHERE src <> dst AND src <> '' GROUP BY 1, 2),
b AS (SELECT 'trust' AS kind, src AS host, dst, pages FROM g UNION ALL SELECT 'distrust', dst, src, pages FROM g),
e AS (SELECT *, sum(pages) OVER (PARTITION BY kind, host) AS wide FROM b),
x0 AS (
  SELECT CASE verdict WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host,
         floor(count(*) * 1000000 * (1 - 0.85::DOUBLE))::BIGINT AS rank
  FROM r WHERE verdict IS NOT NULL GROUP BY 1, 2),{",".join(walk)},
s AS (
  SELECT host, coalesce(sum(rank) FILTER (WHERE kind = 'trust'), 0)::BIGINT AS t,
         coalesce(sum(rank) FILTER (WHERE kind = 'distrust'), 0)::BIGINT AS d
  FROM ({every}) GROUP BY 1)
SELECT page_id, r.host, path, rule,
       coalesce(verdict, CASE WHEN coalesce(d, 0) > (coalesce(t, 0) + coalesce(d, 0)) * 0.5::DOUBLE THEN 'block' ELSE 'allow' END)
         AS verdict,
       coalesce(t, 0) / 1000000::DOUBLE AS trust, coalesce(d, 0) / 1000000::DOUBLE AS distrust
FROM r LEFT JOIN s ON r.host = s.host
"""


OP13 = rf"""
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws
  FROM documents),
i AS (SELECT t, min(doc_id) AS first FROM w GROUP BY 1),
l AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY 1),
m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END) ||
         (CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END) ||
         (CASE WHEN 100 * length(regexp_replace(w.t, '[^A-Z]', '', 'g')) > 2 * length(w.t) THEN 'C' ELSE '' END) ||
         (CASE WHEN regexp_matches(w.t, '[#$%&*|]') THEN 'D' ELSE '' END) ||
         (CASE WHEN w.doc_id > first THEN 'E' ELSE '' END) AS mask
  FROM w JOIN i ON w.t = i.t LEFT JOIN l ON w.doc_id = l.doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY 1, 2),
a(f) AS (SELECT unnest(['A', 'B', 'C', 'D', 'E'])),
o AS (
  SELECT p.f || q.f || r.f || s.f || t.f AS filter_order FROM a p, a q, a r, a s, a t
  WHERE len(list_distinct([p.f, q.f, r.f, s.f, t.f])) = 5),
z AS (
  SELECT c.*, filter_order, step, filter_order[step] AS f, contains(mask, filter_order[step]) AS hit,
         length(translate(mask, filter_order[1:step - 1], '')) < length(mask) AS gone
  FROM c, o, (SELECT unnest(range(1, 6)) AS step)),
g AS (
  SELECT part, filter_order, step::INT AS step, f,
         coalesce(sum(n) FILTER (WHERE NOT gone AND NOT hit), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (WHERE NOT gone AND hit), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (WHERE gone AND hit), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (WHERE mask = f), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (WHERE NOT gone AND hit), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE NOT gone AND hit), 0)::BIGINT AS toxic_lost
  FROM z GROUP BY 1, 2, 3, 4)
SELECT * EXCLUDE (f), (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM g
"""

ORACLE_SQL = {
    "op3_host_rules": OP3,
    "op5_minhash_oph": OP5,
    "op7_fair_queueing": OP7,
    "op10_winnowing": OP10,
    "op11_link_graph": _op11(),
    "op13_decision_diagrams": OP13,
}

"""DuckDB SQL for the license scan, the source divergence and the centroid clustering.

They compute the same results by plain routes: words compared as words instead of
hashes, dense products instead of stripes, all distances instead of bounds.
"""

from __future__ import annotations

from bibflow.llm import centroid_clustering as cc
from bibflow.llm import license_scan as ls
from bibflow.llm import source_divergence as sv

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def license_scan() -> str:
    templates = [*ls.BASE, *ls.NOTICES]
    rows = ", ".join(f"({n}, '{t.label}', {str(t.exact).lower()}, {t.words!r}, {t.keys!r}::INT[])" for n, t in enumerate(templates))
    gram = " AND ".join(f"w[i + {j + 1}] = t.words[t.place + {j + 1}]" for j in range(ls.GRAM))
    reach = ", ".join(f"place + {j}" for j in range(ls.GRAM))
    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
t0(template, label, exact, words, keys) AS (VALUES {rows}),
t AS (SELECT *, unnest(range(0, len(words) - {ls.GRAM} + 1)) AS place FROM t0),
g AS (SELECT doc_id, w, i FROM (SELECT doc_id, w, unnest(range(0, len(w) - {ls.GRAM} + 1)) AS i FROM d WHERE len(w) >= {ls.GRAM})),
hits AS (SELECT doc_id, template, i - t.place AS diagonal, t.place FROM g JOIN t ON {gram}),
votes AS (SELECT doc_id, template, diagonal, count(*) AS n FROM hits GROUP BY ALL),
near AS (SELECT v.doc_id, v.template, v.diagonal, any_value(v.n) AS n,
           max(u.n) FILTER (WHERE u.diagonal < v.diagonal) AS before, max(u.n) FILTER (WHERE u.diagonal > v.diagonal) AS after
         FROM votes v JOIN votes u ON u.doc_id = v.doc_id AND u.template = v.template AND abs(u.diagonal - v.diagonal) <= {ls.SLACK}
         GROUP BY ALL),
cells AS (SELECT doc_id, template, diagonal, unnest([{reach}]) AS c FROM hits),
cover AS (SELECT n.doc_id, n.template, n.diagonal, list_distinct(list(c.c)) AS covered, list_distinct(list(c.c + c.diagonal)) AS places
          FROM near n JOIN cells c ON c.doc_id = n.doc_id AND c.template = n.template AND abs(c.diagonal - n.diagonal) <= {ls.SLACK} GROUP BY ALL),
spans AS (
  SELECT n.doc_id, label, exact, n.diagonal AS start,
    CASE WHEN exact THEN 1.0::DOUBLE ELSE least(len(covered), len(places))::DOUBLE
      / (len(words) + list_max(places) - list_min(places) + 1 - len(places)) END AS score,
    CASE WHEN exact THEN n.n = len(words) - {ls.GRAM} + 1
      ELSE n.n > coalesce(before, 0) AND n.n >= coalesce(after, 0) AND list_has_all(covered, keys) END AS good
  FROM near n JOIN cover USING (doc_id, template, diagonal) JOIN t0 USING (template)),
found AS (SELECT doc_id, count(*) FILTER (WHERE exact) AS n_base, min(start) FILTER (WHERE exact) AS first_word,
    max(start) FILTER (WHERE exact) AS last_word,
    array_to_string(list_sort(list_distinct(list(label) FILTER (WHERE exact))), ',') AS base_labels,
    array_to_string(list_sort(list_distinct(list(label))), ',') AS labels, max(score) AS score
  FROM spans WHERE good AND (exact OR score >= {ls.MIN_SCORE}) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
FROM d LEFT JOIN found USING (doc_id)
"""


def source_divergence() -> str:
    part = f"1 + ({sv.SCALE}::HUGEINT * (coalesce(n, 0) + 1)) // (size + v)"
    return rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
tok AS (SELECT lang, source, r, unnest(w) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term FROM tok GROUP BY lang, term HAVING count(DISTINCT r) >= {sv.MIN_DOCS}),
cnt AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM tok JOIN kept USING (lang, term) GROUP BY ALL),
vocab AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
grp AS (SELECT lang, source, coalesce(size, 0) AS size, coalesce(v, 0) AS v FROM (SELECT DISTINCT lang, source FROM d)
        LEFT JOIN (SELECT lang, source, sum(n) AS size FROM cnt GROUP BY ALL) USING (lang, source) LEFT JOIN vocab USING (lang)),
p AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, {part} AS p
      FROM grp g JOIN kept k USING (lang) LEFT JOIN cnt c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
q AS (SELECT lang, term, {part} AS q FROM (SELECT lang, term, sum(n) AS n FROM cnt GROUP BY ALL)
      JOIN (SELECT lang, sum(size) AS size, any_value(v) AS v FROM grp GROUP BY lang) USING (lang)),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
          FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL),
zero AS (SELECT a.lang, a.source, 'pair', b.source, 0 FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source WHERE a.v = 0),
terms AS (SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
           FROM (SELECT * FROM pairs UNION ALL SELECT * FROM zero UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked
WHERE part = 'pair' OR rank <= {sv.TOP}
"""


def centroid_clustering() -> str:
    ctes = [f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({cc.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = {cc.DIMS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {cc.DIMS})""",
            f"""x AS MATERIALIZED (SELECT r, unnest(range(0, {cc.DIMS})) AS d, unnest(x) AS v FROM kept)""",
            f"""first AS (SELECT r, row_number() OVER (ORDER BY sha256('{cc.SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')), x) - 1 AS c
  FROM kept QUALIFY c < {cc.CLUSTERS})""",
            "c0 AS MATERIALIZED (SELECT c, d, v FROM first JOIN x USING (r))"]
    for i in range(cc.ROUNDS + 1):
        ctes.append(f"""a{i} AS MATERIALIZED (SELECT r, c, CAST(s AS BIGINT) AS s FROM (SELECT r, c, sum((x.v - k.v) * (x.v - k.v)) AS s
  FROM x JOIN c{i} k USING (d) GROUP BY r, c) QUALIFY row_number() OVER (PARTITION BY r ORDER BY s, c) = 1)""")
        if i < cc.ROUNDS:
            ctes.append(f"""c{i + 1} AS MATERIALIZED (SELECT k.c, k.d, coalesce(m.v, k.v) AS v FROM c{i} k LEFT JOIN (
  SELECT c, d, CASE WHEN sum(x.v) >= 0 THEN sum(x.v) // count(*) ELSE -((count(*) - 1 - sum(x.v)) // count(*)) END AS v
  FROM a{i} JOIN x USING (r) GROUP BY c, d) m USING (c, d))""")
    n = cc.ROUNDS
    return "WITH " + ",\n".join(ctes) + f""",
names AS (SELECT c, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{n} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, s AS distance, CAST(sum(s) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(s) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{n} JOIN kept USING (r) JOIN names USING (c)
"""

"""DuckDB SQL for the operators on pages, embeddings and conversations."""

from __future__ import annotations

from leakscope.llm import centroids, convtrie, urltree


def urls() -> str:
    def form(s: str) -> str:
        when = " ".join("WHEN " + " AND ".join(f"regexp_matches({s}, '{p}')" for p in patterns) + f" THEN '{name}'"
                        for patterns, name in urltree.FORMS)
        return f"CASE {when} ELSE '/' || {s} END"
    n = urltree.LEVELS
    rules = sorted(urltree.RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v) for v, h, p in rules]
    rule = " ".join(f"WHEN {w} THEN '{r}'" for w, r, _ in fits)
    label = " ".join(f"WHEN {w} THEN '{v}'" for w, _, v in fits)
    levels = "".join(f""",
a{k} AS MATERIALIZED (SELECT *, shape[{k + 1}] AS seg, CASE WHEN starts_with(shape[{k + 2}], '/') THEN '/' ELSE shape[{k + 2}] END AS below FROM t{k}),
s{k} AS (SELECT host, way, seg, sum(n) AS m, sum(sum(n)) OVER (PARTITION BY host, way) AS of_m FROM a{k} GROUP BY host, way, seg),
b{k} AS MATERIALIZED (SELECT a.* REPLACE (CASE WHEN of_m >= {urltree.MANY} AND m * {urltree.RARE} < of_m AND starts_with(seg, '/')
                                           THEN '*' ELSE seg END AS seg) FROM a{k} a JOIN s{k} USING (host, way, seg)),
c{k} AS MATERIALIZED (SELECT host, way, seg, below, sum(n) AS n, sum(good) AS good, sum(bad) AS bad,
                      sum(sum(n)) OVER (PARTITION BY host, way, below) AS pn FROM b{k} GROUP BY host, way, seg, below),
h{k} AS (SELECT host, way, seg, sum(n)::DOUBLE AS cn, sum(good)::DOUBLE AS cg, sum(bad)::DOUBLE AS cb,
         sum(n::DOUBLE * n / pn) AS q FROM c{k} GROUP BY host, way, seg),
g{k} AS (SELECT *, sum(cn) OVER w AS pn, sum(cb) OVER w AS pb, sum(cg + cb) OVER w AS pl FROM h{k}
         WINDOW w AS (PARTITION BY host, way)),
d{k} AS (SELECT host, way, count(DISTINCT below) - 1.0::DOUBLE AS df FROM c{k} GROUP BY host, way),
r{k} AS (SELECT *, CASE WHEN pl > 0 THEN pb / pl ELSE 0 END AS rate,
         CASE WHEN df > 0 THEN df * pow(1 - 2 / (9 * df) + {urltree.Z} * sqrt(2 / (9 * df)), 3) ELSE 0 END AS lim
         FROM g{k} JOIN d{k} USING (host, way)),
m{k} AS (SELECT host, way, seg, q / (cn / pn) - cn <= lim + 1e-9 AND cn < pn
         AND abs(cb - rate * (cg + cb)) <= {urltree.Z} * sqrt((cg + cb) * rate * (1 - rate)) + 1e-9 AS alike FROM r{k}),
t{k + 1} AS MATERIALIZED (SELECT host, shape, n, good, bad, list_append(way, CASE WHEN alike THEN '~' ELSE seg END) AS way
         FROM b{k} JOIN m{k} USING (host, way, seg))""" for k in range(n))
    return rf"""
WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path FROM pages),
parts AS (SELECT *, string_split(CASE WHEN starts_with(path, '/') THEN substr(path, 2) ELSE path END, '/') AS l FROM p),
u AS MATERIALIZED (SELECT page_id, host, path, CASE {rule} END AS rule, CASE {label} END AS label,
      list_concat(list_transform(list_slice(l, 1, {n}), lambda s: {form('s')}),
                  CASE WHEN len(l) > {n} THEN ['{{deep}}'] ELSE list_transform(range({n + 1} - len(l)), lambda i: '{urltree.END}') END) AS shape
      FROM parts),
t0 AS (SELECT host, shape, count(*) AS n, count(*) FILTER (label = 'allow') AS good, count(*) FILTER (label = 'block') AS bad,
       []::VARCHAR[] AS way FROM u GROUP BY host, shape){levels},
f AS (SELECT host, shape, array_to_string(way, '/') AS template, (sum(good) OVER w)::BIGINT AS n_allow,
      (sum(bad) OVER w)::BIGINT AS n_block FROM t{n} WINDOW w AS (PARTITION BY host, way))
SELECT page_id, host, path, rule, CASE WHEN rule IS NOT NULL THEN label
         WHEN (n_block + 1) / (n_allow + n_block + 2) >= {urltree.PURITY} THEN 'block' ELSE 'allow' END AS verdict,
       template, n_allow, n_block
FROM u JOIN f USING (host, shape)"""


def clusters() -> str:
    def nearest(c: str) -> str:
        return f"""SELECT rid, min(k) FILTER (dist = least_dist) AS k, any_value(least_dist) AS dist FROM (
  SELECT *, min(dist) OVER (PARTITION BY rid) AS least_dist FROM (
    SELECT rid, k, sum((e.x - c.x) * (e.x - c.x)) AS dist FROM e JOIN {c} c USING (i) GROUP BY rid, k)) GROUP BY rid"""
    rounds = "".join(f""",
a{r} AS MATERIALIZED ({nearest(f'c{r}')}),
s{r} AS (SELECT k, i, sum(x) AS s, count(*) AS n FROM e JOIN a{r} USING (rid) GROUP BY k, i),
c{r + 1} AS MATERIALIZED (SELECT k, i, coalesce((s - ((s % n) + n) % n) // n, x)::BIGINT AS x FROM c{r} LEFT JOIN s{r} USING (k, i))"""
                     for r in range(centroids.ROUNDS))
    last = f"c{centroids.ROUNDS}"
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id,
      list_transform(embedding, lambda x: floor({centroids.SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
      WHERE len(embedding) = {centroids.SIZE} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {centroids.SIZE}),
e AS MATERIALIZED (SELECT rid, unnest(v) AS x, unnest(range(len(v))) AS i FROM v),
c0 AS MATERIALIZED (SELECT k, unnest(v) AS x, unnest(range(len(v))) AS i FROM (
  SELECT v, row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, v) - 1 AS k FROM v) WHERE k < {centroids.CLUSTERS}){rounds},
f AS MATERIALIZED ({nearest(last)}),
h AS (SELECT k, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM {last} GROUP BY k)
SELECT vec_id, k::INTEGER AS cluster, dist::BIGINT AS distance, (sum(dist) OVER (PARTITION BY k))::BIGINT AS cluster_inertia,
       (sum(dist) OVER ())::BIGINT AS inertia, centroid_sha256
FROM f JOIN v USING (rid) JOIN h USING (k)"""


def trie() -> str:
    return f"""
WITH tab AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda a, k:
         CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, n)) AS t),
turns AS (SELECT conv_id, octet_length(encode(x))::BIGINT AS b, m, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, m) AS i
  FROM (SELECT conv_id, turn, coalesce(text, '') AS x,
          md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS m
        FROM conversations WHERE conv_id IS NOT NULL)),
own AS (SELECT conv_id, list(m ORDER BY i) AS l, list(b ORDER BY i) AS b FROM turns GROUP BY conv_id),
hs AS (SELECT *, conv_id - conv_id % {convtrie.STRIDE} AS base, xor(list_reduce(
         list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
         lambda a, c: xor(a >> 8, t[(xor(a, c) & 255) + 1]), 4294967295::BIGINT), 4294967295) % {convtrie.HEADS} AS h FROM own, tab),
r AS (SELECT a.conv_id, list_concat(list_slice(coalesce(o.l, []), 1, h), list_slice(a.l, h + 1, len(a.l))) AS l,
             list_concat(list_slice(coalesce(o.b, []), 1, h), list_slice(a.b, h + 1, len(a.b))) AS b
      FROM hs a LEFT JOIN own o ON o.conv_id = a.base),
p AS MATERIALIZED (SELECT conv_id, d, array_to_string(list_slice(l, 1, d), '') AS k, array_to_string(list_slice(l, 1, d - 1), '') AS up,
       coalesce(b[d], 0) AS nb, len(l) = d AS ends FROM (SELECT *, unnest(range(0, len(l) + 1)) AS d FROM r)),
n AS MATERIALIZED (SELECT d, k, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(nb) AS nb,
       string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends) AS ids FROM p GROUP BY d, k),
c AS (SELECT d - 1 AS d, up AS k, count(*) AS n_children FROM n WHERE d > 0 GROUP BY d, up),
nc AS MATERIALIZED (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN c USING (d, k)),
sub AS (SELECT p.d, p.k, sum((n_convs - 1) * nc.nb) AS saved, count(*) FILTER (n_children = 0) AS n_leaves
        FROM nc JOIN p ON p.conv_id = nc.conv_id AND p.d <= nc.d GROUP BY p.d, p.k)
SELECT nc.conv_id, nc.d AS depth, u.conv_id AS parent_conv_id, nc.n_convs, nc.n_children, n_leaves::BIGINT AS n_leaves,
       saved::BIGINT AS saved_tokens, sha256(coalesce(nc.ids, '')) AS ends_sha256
FROM nc JOIN sub USING (d, k) LEFT JOIN n u ON nc.d > 0 AND u.d = nc.d - 1 AND u.k = nc.up"""

"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from inkwell.llm.licences import NOTICES, THRESHOLD

_notices = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in NOTICES)



def _centroid_rounds(k: int = 8, rounds: int = 10, dim: int = 64) -> str:
    """Plain Lloyd rounds, every distance computed."""
    parts = [f"""rows AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim}),
xs AS MATERIALIZED (
  SELECT r, vec_id, i, floor(1024 * embedding[i]::DOUBLE)::HUGEINT AS x
  FROM rows, (SELECT unnest(range(1, {dim + 1})) AS i)),
seeds AS MATERIALIZED (
  SELECT r, row_number() OVER (ORDER BY sha256('3:' || vec_id), embedding) - 1 AS c FROM rows
  QUALIFY c < {k}),
c0 AS MATERIALIZED (SELECT c, i, x FROM seeds JOIN xs USING (r))"""]
    for n in range(rounds + 1):
        parts.append(f"""a{n} AS MATERIALIZED (
  SELECT r, vec_id, arg_min(c, (d, c)) AS c, min(d) AS d
  FROM (SELECT r, vec_id, c, sum((xs.x - m.x) * (xs.x - m.x))::HUGEINT AS d
        FROM xs JOIN c{n} m USING (i) GROUP BY r, vec_id, c)
  GROUP BY r, vec_id)""")
        if n < rounds:
            parts.append(f"""c{n + 1} AS MATERIALIZED (
  SELECT c, i, coalesce((s - ((s % n) + n) % n) // n, x) AS x
  FROM c{n} LEFT JOIN (SELECT c, i, sum(xs.x)::HUGEINT AS s, count(*)::HUGEINT AS n
                       FROM a{n} JOIN xs USING (r) GROUP BY c, i) USING (c, i))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, c::INT AS cluster, d::BIGINT AS distance,
       (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256
                     FROM c{rounds} GROUP BY c) USING (c)
"""


def _manifest(levels: int = 5) -> str:
    """Trees of up to 16^levels nodes; every node is hashed from its children's texts."""
    def field(c):
        v = f"({c})::VARCHAR"
        return f"coalesce(octet_length(encode({v}))::VARCHAR || ':' || {v}, '-')"

    def leaf(text):
        return "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    upper = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    parts = [f"""leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p
  FROM (SELECT doc_id, source, {leaf("text")} AS leaf, {leaf(f"translate(text, {upper})")} AS changed FROM documents)),
t0 AS MATERIALIZED (SELECT source AS g, p AS idx, leaf AS h FROM leaves)"""]

    def up(name, n):
        return f"""{name}{n + 1} AS MATERIALIZED (
  SELECT g, idx // 16 AS idx, sha256(string_agg(h, '' ORDER BY idx)) AS h
  FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM {name}{n}) WHERE n > 1 GROUP BY g, idx // 16
  UNION ALL SELECT g, idx, h FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM {name}{n}) WHERE n = 1)"""

    def fold(level, name, n, before):
        # A tree's single node has no siblings: the value goes on as it is.
        return f"""f{level} AS MATERIALIZED (
  SELECT f.p, f.source, any_value(f.tree) AS tree, any_value(f.idx) // 16 AS idx,
         any_value(f.proof) || coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (s.idx <> f.idx), '') AS proof,
         CASE WHEN any_value(n) = 1 THEN any_value(f.now)
              ELSE sha256(string_agg(CASE WHEN s.idx = f.idx THEN f.now ELSE s.h END, '' ORDER BY s.idx)) END AS now
  FROM {before} f JOIN (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM {name}{n}) s
    ON s.g IS NOT DISTINCT FROM f.tree AND s.idx // 16 = f.idx // 16
  GROUP BY f.p, f.source)"""

    for n in range(levels):
        parts.append(up("t", n))
    parts.append(f"""s0 AS MATERIALIZED (
  SELECT '' AS g, row_number() OVER (ORDER BY encode(g) NULLS FIRST) - 1 AS idx, h, g AS source FROM t{levels})""")
    parts += [up("s", n) for n in range(levels)]
    parts.append("""f0 AS MATERIALIZED (
  SELECT p, source, source AS tree, p AS idx, '' AS proof,
         CASE WHEN doc_id IS NOT NULL AND crc_hit THEN changed ELSE leaf END AS now
  FROM (SELECT l.*, coalesce(c.hit, false) AS crc_hit FROM leaves l LEFT JOIN crc_hits c USING (doc_id)))""")
    parts += [fold(n + 1, "t", n, f"f{n}") for n in range(levels)]
    parts.append(f"""g0 AS MATERIALIZED (
  SELECT f.p, f.source, '' AS tree, s.idx, f.proof, f.now FROM f{levels} f JOIN s0 s ON s.source IS NOT DISTINCT FROM f.source)""")
    parts += [fold(n + 1, "s", n, f"g{n}").replace(f"f{n + 1} AS", f"g{n + 1} AS", 1) for n in range(levels)]
    return f"""WITH RECURSIVE ids AS (SELECT DISTINCT doc_id, doc_id::VARCHAR AS t FROM documents WHERE doc_id IS NOT NULL),
crc AS (  -- CRC-32 bit by bit, eight steps per character
  SELECT doc_id, t, 0 AS k, 4294967295::BIGINT AS x FROM ids
  UNION ALL
  SELECT doc_id, t, k + 1, CASE WHEN (z & 1) = 1 THEN xor(z >> 1, 3988292384) ELSE z >> 1 END
  FROM (SELECT doc_id, t, k, CASE WHEN k % 8 = 0 THEN xor(x, ascii(t[k // 8 + 1])::BIGINT) ELSE x END AS z
        FROM crc WHERE k < 8 * length(t))),
crc_hits AS MATERIALIZED (
  SELECT doc_id, xor(x, 4294967295) % 5 = 0 AS hit FROM crc WHERE k = 8 * length(t)),
{",{0}".format(chr(10)).join(parts)}
SELECT l.doc_id, l.leaf, sub.h AS subroot, top.h AS root, sha256(f.proof) AS proof_sha256,
       f.now AS folded_root, f.now = top.h AS verified
FROM leaves l JOIN g{levels} f ON f.p = l.p AND f.source IS NOT DISTINCT FROM l.source
JOIN s0 sub ON sub.source IS NOT DISTINCT FROM l.source
CROSS JOIN (SELECT h FROM s{levels}) top
"""


ORACLES: dict[str, str] = {
    "op11_centroids": _centroid_rounds(),
    "op12_manifest": _manifest(),
    "op13_multi_index": """
WITH RECURSIVE vectors AS (
  SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS x FROM embeddings),
fit AS (
  SELECT * FROM vectors
  WHERE label IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda v: v IS NOT NULL AND isfinite(v))) = len(x)
    AND len(list_filter(x, lambda v: v <> 0)) > 0),
links AS MATERIALIZED (
  SELECT a.r AS r, b.r AS other FROM fit a JOIN fit b ON a.label = b.label AND a.r <> b.r AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
reach AS (
  SELECT r, r AS other FROM vectors
  UNION SELECT reach.r, links.other FROM reach JOIN links ON links.r = reach.other),
named AS (
  SELECT reach.r, min(v.vec_id) AS component_id FROM reach JOIN vectors v ON v.r = reach.other GROUP BY reach.r)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, v.vec_id IS NOT DISTINCT FROM c.component_id AS kept
FROM vectors v JOIN named c USING (r) LEFT JOIN (SELECT r, count(*) AS n FROM links GROUP BY r) n USING (r)
""",
    "op4_url_filters": r"""
WITH split AS (
  SELECT page_id, url,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages),
hosts AS (
  SELECT page_id, url, rest IS NOT NULL AS given,
         coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM split)
SELECT page_id, url, host, path,
       CASE WHEN c_de THEN 'example.com/de/' WHEN n_en THEN 'example.net/en/'
            WHEN o_fr THEN 'org/fr/' WHEN net THEN 'net/' END AS rule,
       CASE WHEN c_de THEN 'block' WHEN n_en THEN 'allow'
            WHEN o_fr THEN 'allow' WHEN net THEN 'block' ELSE 'allow' END AS verdict
FROM (SELECT *,
        given AND ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') AS c_de,
        given AND ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') AS n_en,
        given AND ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') AS o_fr,
        given AND ('.' || host) LIKE '%.net' AND starts_with(path, '/') AS net
      FROM hosts)
""",
    "op10_license_scans": rf"""
WITH notices(name, notice) AS (VALUES {_notices}),
listed AS (
  SELECT DISTINCT name, notice, list_filter(string_split_regex(lower(notice), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w
  FROM notices),
templates AS (
  SELECT name, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b FROM listed),
parts AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
lines AS (SELECT doc_id, unnest(range(len(ls))) AS line_no, unnest(ls) AS line FROM parts),
worded AS (
  SELECT *, list_filter(string_split_regex(lower(line), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w FROM lines),
grams AS (
  SELECT doc_id, line_no, line,
         list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS a
  FROM worded WHERE len(w) > 1),
scored AS (
  SELECT doc_id, line_no, line, name,
         2.0 * len(list_intersect(a, b)) / (len(a) + len(b)) AS dice
  FROM grams JOIN templates ON len(a) BETWEEN len(b) / 2.0 AND len(b) * 2.0)
SELECT doc_id, line_no, arg_min(name, (-dice, name)) AS license, max(dice) AS dice, line
FROM scored WHERE dice >= {THRESHOLD} GROUP BY doc_id, line_no, line
""",
}

"""DuckDB SQL of queries whose rounds or levels are written out one by one."""

from __future__ import annotations

#: Levels written out: a source of up to 3 ** 12 documents, up to 3 ** 8 sources.
LEVELS, TOP_LEVELS = 12, 8


def clustering_sql(dimensions: int = 64, clusters: int = 16, rounds: int = 3, scale: int = 64) -> str:
    parts = [f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda e: CAST(floor(CAST(e AS DOUBLE) * {scale}) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) = {dimensions}
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0)""", f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), x) - 1 AS c, x FROM v WHERE vec_id IS NOT NULL
  ORDER BY sha256('1:' || vec_id), x LIMIT {clusters})"""]
    for k in range(rounds + 1):
        parts.append(f"""a{k} AS MATERIALIZED (
  SELECT rid, vec_id, x, c, d FROM (
    SELECT *, row_number() OVER (PARTITION BY rid ORDER BY d, c) AS best FROM (
      SELECT v.rid, v.vec_id, v.x, c.c, CAST(list_sum(list_transform(list_zip(v.x, c.x), lambda t: (t[1] - t[2]) * (t[1] - t[2]))) AS BIGINT) AS d
      FROM v, c{k} c)) WHERE best = 1)""")
        if k < rounds:
            parts.append(f"""c{k + 1} AS MATERIALIZED (
  SELECT c.c, coalesce(m.x, c.x) AS x FROM c{k} c LEFT JOIN (
    SELECT c, list(m ORDER BY i) AS x FROM (
      SELECT c, i, CAST(floor(CAST(sum(x[i]) AS DOUBLE) / count(*)) AS BIGINT) AS m FROM a{k}, range(1, {dimensions + 1}) t(i) GROUP BY c, i) GROUP BY c) m ON m.c = c.c)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(k.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} k ON a.c = k.c"""


def _tree(name: str, key: str, levels: int) -> list[str]:
    """Levels of the trees in ``name``0 (key, i, d, t nodes of the tree at this level), and each node's siblings."""
    parts = []
    for k in range(levels):
        run = f"(PARTITION BY {key}, i // 3 ORDER BY i ROWS BETWEEN"
        parts.append(f"""{name}s{k} AS (SELECT {key}, i, string_agg(d, '') OVER {run} UNBOUNDED PRECEDING AND 1 PRECEDING) AS a,
  string_agg(d, '') OVER {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS b FROM {name}{k} WHERE t > 1)""")
        parts.append(f"""{name}{k + 1} AS MATERIALIZED (SELECT {key}, i // 3 AS i, sha256(string_agg(d, '' ORDER BY i)) AS d, (t + 2) // 3 AS t
  FROM {name}{k} WHERE t > 1 GROUP BY {key}, i // 3, t)""")
    return parts


def _climb(name: str, key: str, levels: int, first: str, out: str) -> list[str]:
    """Fold x and gather the siblings p from level to level: ``first`` has j, x and p and every column to keep."""
    parts, before = [], first
    for k in range(levels):
        now = f"{out}{k}"
        parts.append(f"""{now} AS (SELECT f.* REPLACE (f.j // 3 AS j, CASE WHEN s.i IS NULL THEN f.x ELSE sha256(coalesce(s.a, '') || f.x || coalesce(s.b, '')) END AS x,
  f.p || coalesce(s.a, '') || coalesce(s.b, '') AS p)
  FROM {before} f LEFT JOIN {name}s{k} s ON f.{key} IS NOT DISTINCT FROM s.{key} AND f.j = s.i)""")
        before = now
    return parts


def manifest_sql() -> str:
    field = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')"
    head = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    crc = """list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))"""
    subroots = " UNION ALL ".join(f"SELECT source, d FROM n{k} WHERE t = 1" for k in range(LEVELS + 1))
    root = " UNION ALL ".join(f"SELECT d FROM r{k} WHERE t = 1" for k in range(TOP_LEVELS + 1))
    parts = [
        f"""l AS MATERIALIZED (SELECT doc_id, source, sha256({head} || {field('text')}) AS leaf, sha256({head} || {field('seen')}) AS x
  FROM (SELECT *, CASE WHEN xor({crc}, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS seen FROM documents))""",
        """n AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS j,
  count(*) OVER (PARTITION BY source) AS t FROM l)""",
        "n0 AS (SELECT source, j AS i, leaf AS d, t FROM n)", *_tree("n", "source", LEVELS),
        f"subroots AS MATERIALIZED (SELECT source, d, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS t FROM ({subroots}))",
        "r0 AS (SELECT 0 AS w, i, d, t FROM subroots)", *_tree("r", "w", TOP_LEVELS),
        "f AS (SELECT n.*, '' AS p FROM n)", *_climb("n", "source", LEVELS, "f", "f"),
        f"g AS (SELECT f.doc_id, f.leaf, s.d AS subroot, 0 AS w, s.i AS j, f.x, f.p FROM f{LEVELS - 1} f JOIN subroots s ON f.source IS NOT DISTINCT FROM s.source)",
        *_climb("r", "w", TOP_LEVELS, "g", "g")]
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, root, sha256(p) AS proof_sha256, x AS folded_root, x = root AS verified
FROM g{TOP_LEVELS - 1}, (SELECT d AS root FROM ({root}))"""

"""DuckDB SQL for the operators that it can express."""

from __future__ import annotations


def sharding(limit: int) -> str:
    """Holds while every shard can split, as with distinct ids."""
    return f"""
WITH sized AS (
  SELECT doc_id,
    CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS UBIGINT)
      AS BIGINT) AS hash,
    CAST(coalesce(octet_length(encode(text)), 0) AS BIGINT) AS n_bytes
  FROM documents),
nodes AS (
  SELECT depth, hash >> (32 - depth) AS prefix, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes
  FROM sized, range(0, 33) AS d(depth) GROUP BY ALL),
placed AS (
  SELECT s.doc_id, s.hash, s.n_bytes, n.depth, n.prefix, n.shard_bytes,
    row_number() OVER (PARTITION BY s.doc_id ORDER BY n.depth) AS n
  FROM sized s JOIN nodes n ON n.prefix = s.hash >> (32 - n.depth)
  WHERE n.shard_bytes <= {limit})
SELECT doc_id, n_bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), CAST(depth AS INT), '0')
    END AS shard,
  CAST(depth AS INT) AS depth, CAST(0 AS BIGINT) AS page, shard_bytes
FROM placed WHERE n = 1"""


def jaccard(width: int, percent: int) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), '{upper}', '{lower}'), '[\\x20\\x09-\\x0D]+'),
    lambda w: w <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < {width} THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, CAST(len(w) - {width - 2} AS BIGINT)),
      lambda i: array_to_string(w[i:i + {width - 1}], ' '))) END AS s
  FROM words),
elements AS (SELECT doc_id, len(s) AS n, unnest(s) AS e FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM elements a JOIN elements b ON a.e = b.e AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
reach AS (
  SELECT a, b FROM links
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles,
  least(sets.doc_id, coalesce(min(reach.b), sets.doc_id)) AS component_id
FROM sets LEFT JOIN reach ON reach.a = sets.doc_id
GROUP BY sets.doc_id, len(s)"""


WARC = """
WITH hashed AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
digits AS (
  SELECT page_id, octet_length(encode(payload)) AS n, payload,
    array_to_string(list_transform(range(0, 32), lambda k: substr(
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + ((CAST('0x' || substr(h, 1 + 5 * CAST(k // 4 AS INT), 5) AS BIGINT)
        >> (15 - 5 * (k % 4))) & 31), 1)), '') AS digest
  FROM hashed),
owned AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS owner FROM digits)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> owner THEN owner END AS refers_to
FROM owned"""


def clustering(centroids: int, rounds: int, dimensions: int) -> str:
    """A full search in every round, on whole numbers."""
    steps = [
        f"""
WITH whole AS (
  SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
  WHERE len(embedding) = {dimensions}
    AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = {dimensions}
), kept AS MATERIALIZED (
  SELECT r, vec_id,
    list_transform(embedding, lambda c: CAST(floor(64 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM whole
), places AS (
  SELECT x, row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)) NULLS LAST, x) - 1 AS cluster
  FROM kept
), c0 AS MATERIALIZED (SELECT CAST(cluster AS INTEGER) AS cluster, x AS c FROM places WHERE cluster < {centroids})"""
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""
a{i} AS MATERIALIZED (
  SELECT r, arg_min(cluster, CAST(d AS HUGEINT) * {centroids} + cluster) AS cluster, min(d) AS distance
  FROM (
    SELECT r, cluster, CAST(list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
    FROM kept, c{i}
  ) GROUP BY r
)"""
        )
        if i == rounds:
            break
        steps.append(
            f"""
c{i + 1} AS MATERIALIZED (
  SELECT c{i}.cluster, coalesce(n.c, c{i}.c) AS c
  FROM c{i} LEFT JOIN (
    SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY k) AS c
    FROM (
      SELECT cluster, k, CAST(sum(v) AS HUGEINT) AS s, count(*) AS n
      FROM (
        SELECT a{i}.cluster, unnest(range({dimensions})) AS k, unnest(kept.x) AS v
        FROM kept JOIN a{i} USING (r)
      ) GROUP BY cluster, k
    ) GROUP BY cluster
  ) AS n ON n.cluster = c{i}.cluster
)"""
        )
    last = rounds
    steps.append(
        f"""
sums AS (SELECT cluster, CAST(sum(distance) AS BIGINT) AS cluster_inertia FROM a{last} GROUP BY cluster)
SELECT kept.vec_id, CAST(a.cluster AS INTEGER) AS cluster, a.distance, sums.cluster_inertia,
  (SELECT CAST(sum(cluster_inertia) AS BIGINT) FROM sums) AS inertia,
  sha256(array_to_string(c{last}.c, ',')) AS centroid_sha256
FROM kept JOIN a{last} AS a USING (r) JOIN sums USING (cluster) JOIN c{last} USING (cluster)
"""
    )
    return ",".join(steps[:-1]) + "," + steps[-1]

"""DuckDB counterparts of the queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op10_line_dedup"] = """
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
each AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS position FROM docs),
keyed AS (
  SELECT doc_id, position, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM each),
shared AS (
  SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT e.*, s.k IS NOT NULL AND e.doc_id <> s.last AS gone FROM keyed e LEFT JOIN shared s USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

ORACLES["op7_near_dups"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM words),
sets AS (SELECT DISTINCT doc_id, s FROM windows),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id < y.doc_id
  GROUP BY x.doc_id, y.doc_id),
links AS (
  SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * shared >= 80 * (p.n + q.n - shared)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, goal) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.node, l.b FROM reach r JOIN both_ways l ON l.a = r.goal)
SELECT d.doc_id, coalesce(max(z.n), 0)::BIGINT AS n_shingles, min(r.goal) AS component_id,
  d.doc_id = min(r.goal) AS kept
FROM documents d JOIN reach r ON r.node = d.doc_id LEFT JOIN sizes z ON z.doc_id = d.doc_id GROUP BY d.doc_id
"""


def _centroid_sql(k: int, rounds: int, dims: int) -> str:
    """Exact clustering, one pair of tables for each round."""
    first = f"""
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS cells
  FROM embeddings WHERE len(embedding) = {dims}
    AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = {dims}),
parts AS MATERIALIZED (SELECT vec_id, unnest(cells) AS v, generate_subscripts(cells, 1) AS i FROM vectors),
c0 AS MATERIALIZED (
  SELECT j, unnest(cells) AS v, generate_subscripts(cells, 1) AS i FROM (
    SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS j, cells FROM vectors
    ORDER BY j LIMIT {k}))"""
    steps = [first]
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT vec_id, arg_min(j, (d, j)) AS cluster, min(d) AS distance FROM (
    SELECT vec_id, j, CAST(sum((p.v - c.v) * (p.v - c.v)) AS BIGINT) AS d
    FROM parts p JOIN c{r} c USING (i) GROUP BY vec_id, j) GROUP BY vec_id)""")
        if r < rounds:
            steps.append(f"""
c{r + 1} AS MATERIALIZED (
  SELECT c.j, coalesce(m.v, c.v) AS v, c.i FROM c{r} c LEFT JOIN (
    SELECT cluster AS j, i, CAST((sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS v
    FROM parts JOIN a{r} USING (vec_id) GROUP BY cluster, i) m USING (j, i))""")
    return ",".join(steps) + f"""
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
  CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN (SELECT j AS cluster, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256
  FROM c{rounds} GROUP BY j) USING (cluster)"""


ORACLES["op11_centroids"] = _centroid_sql(40, 5, 64)

# The table of CRC-32, by its rule, and the CRC of a text's UTF-8 bytes. The table is a list in the table ``crc``.
_CRC_STEP = "CASE WHEN {0} & 1 = 1 THEN xor({0} >> 1, 3988292384) ELSE {0} >> 1 END"
_CRC_TABLE = (
    "bits AS (SELECT b, 0 AS step, CAST(b AS BIGINT) AS v FROM range(256) t(b) UNION ALL SELECT b, step + 1, "
    + _CRC_STEP.format("v")
    + " FROM bits WHERE step < 8),\ncrc AS (SELECT list(v ORDER BY b) AS crc_table FROM bits WHERE step = 8)"
)


def _crc(text: str) -> str:
    byte = "CAST('0x' || substr(hex(encode({0})), 2 * i + 1, 2) AS BIGINT)".format(text)
    return (
        f"xor(list_reduce(list_transform(range(strlen({text})), lambda i: {byte}), "
        "lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"
    )


ORACLES["op12_syncmers"] = rf"""
WITH RECURSIVE {_CRC_TABLE},
docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
following AS (
  SELECT doc_id, text, length(text) AS n, coalesce(lead(doc_id) OVER (ORDER BY doc_id), min(doc_id) OVER ()) AS next_id,
    coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS next_text FROM docs),
edits AS (SELECT *, substr(text, 1, n - n // 4) || substr(next_text, 1, n // 4) AS edited FROM following),
texts AS (SELECT doc_id, 'own' AS kind, text FROM edits UNION ALL SELECT doc_id, 'edited', edited FROM edits),
split AS MATERIALIZED (SELECT doc_id, kind, regexp_extract_all(text, '[^\x20\x09-\x0D]{{1,32}}') AS parts FROM texts),
words AS (SELECT doc_id, kind, unnest(parts) AS w, generate_subscripts(parts, 1) AS i FROM split),
numbers AS MATERIALIZED (SELECT w, {_crc("w")} AS v FROM (SELECT DISTINCT w FROM words), crc),
valued AS (SELECT doc_id, kind, i, v FROM words JOIN numbers USING (w)),
rolled AS (
  SELECT doc_id, kind, i, v, lead(v, 1) OVER o AS v1, lead(v, 2) OVER o AS v2, lead(v, 3) OVER o AS v3, lead(v, 4) OVER o AS v4
  FROM valued WINDOW o AS (PARTITION BY doc_id, kind ORDER BY i)),
inner_hashes AS (
  SELECT *, (v * 1000003 + v1) % 2147483647 AS s0, (v1 * 1000003 + v2) % 2147483647 AS s1,
    (v2 * 1000003 + v3) % 2147483647 AS s2, (v3 * 1000003 + v4) % 2147483647 AS s3 FROM rolled WHERE v4 IS NOT NULL),
anchors AS (
  SELECT doc_id, kind, i, ((((v * 48271 + v1) % 2147483647 * 48271 + v2) % 2147483647 * 48271 + v3) % 2147483647 * 48271 + v4)
    % 2147483647 AS anchor
  FROM inner_hashes WHERE CASE WHEN s0 <= s3 THEN s0 <= s1 AND s0 <= s2 ELSE s3 <= s1 AND s3 <= s2 END),
found AS (SELECT doc_id, kind, list(anchor ORDER BY i) AS anchors FROM anchors GROUP BY doc_id, kind),
alone AS (
  SELECT doc_id, kind, CASE WHEN text = '' THEN [] ELSE [{_crc("text")}] END AS anchors
  FROM texts ANTI JOIN found USING (doc_id, kind), crc),
prints AS MATERIALIZED (
  SELECT doc_id, kind, anchors, list_distinct(anchors) AS parts, coalesce(
    array_to_string(list_transform(anchors, lambda a: to_hex(a + 4294967296)), ''), '') AS print
  FROM (SELECT * FROM found UNION ALL SELECT * FROM alone)),
alike AS (
  SELECT e.doc_id, e.n, e.edited, a.print AS own, b.print AS changed, a.parts AS x, b.parts AS y, c.parts AS z
  FROM edits e JOIN prints a ON a.doc_id = e.doc_id AND a.kind = 'own' JOIN prints b ON b.doc_id = e.doc_id AND b.kind = 'edited'
  JOIN prints c ON c.doc_id = e.next_id AND c.kind = 'own')
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, own AS fingerprint, changed AS edited_fingerprint,
  CASE WHEN len(x) + len(y) = 0 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * len(list_intersect(x, y)) / (len(x) + len(y)) END AS near_edited,
  CASE WHEN len(x) + len(z) = 0 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * len(list_intersect(x, z)) / (len(x) + len(z)) END AS near_next
FROM alike
"""

ORACLES["op13_spelling"] = rf"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS MATERIALIZED (SELECT doc_id, run, count(*) AS k FROM runs WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (SELECT run, k, {_crc("(doc_id || ':' || run)")} AS h FROM counted, crc),
changed AS (
  SELECT k, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
  FROM hashed),
words AS MATERIALIZED (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM changed WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
near AS MATERIALIZED (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM words a JOIN words b
    ON length(a.word) BETWEEN length(b.word) - 1 AND length(b.word) + 1 AND a.word <> b.word
  WHERE length(a.word) <= length(b.word) AND levenshtein(a.word, b.word) = 1),
both_ways AS (
  SELECT * FROM near UNION SELECT other, other_n, word, n FROM near),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM both_ways GROUP BY word),
found AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * w.n THEN other END AS form,
    CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n FROM words w LEFT JOIN best USING (word)),
steps(word, here) AS (
  SELECT word, word FROM found UNION ALL SELECT s.word, f.form FROM steps s JOIN found f ON f.word = s.here WHERE f.form IS NOT NULL)
SELECT f.word, f.form, s.here AS root, f.n, f.n_near, f.form_n
FROM found f JOIN steps s ON s.word = f.word JOIN found g ON g.word = s.here WHERE g.form IS NULL
"""

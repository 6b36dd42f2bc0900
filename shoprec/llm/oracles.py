"""DuckDB SQL for the queries that SQL can express."""

_WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
kept AS (SELECT html, max(page_id) AS keeper FROM p GROUP BY html)
SELECT page_id, strlen(p.html)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INTEGER, 1)), '')
         AS payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = keeper THEN NULL ELSE keeper END AS refers_to
FROM p JOIN kept ON kept.html = p.html
"""

_JACCARD = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS t
  FROM documents
),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(t) >= 3 THEN list_distinct(list_transform(range(1, len(t) - 1),
         lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2])) WHEN len(t) > 0 THEN [array_to_string(t, ' ')]
         ELSE [] END) AS x
  FROM w
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
links AS (
  SELECT a, b FROM shared JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * c >= 90 * (p.n + q.n - c)
),
reach AS (
  SELECT doc_id, doc_id AS root FROM n
  UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.doc_id
)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(min(r.root), w.doc_id) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN reach r ON r.doc_id = w.doc_id GROUP BY w.doc_id, n.n
"""

_REPEATS = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
placed AS (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 199)) AS i FROM d),
named AS (SELECT doc_id, i, md5(substr(h, 1 + 2 * i, 400)) AS x FROM placed),
often AS (SELECT x FROM named GROUP BY x HAVING count(*) > 1),
hit AS (SELECT doc_id, i FROM named WHERE x IN (SELECT x FROM often)),
marked AS (
  SELECT doc_id, i, CASE WHEN i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200 THEN 1 ELSE 0 END AS fresh
  FROM hit
),
numbered AS (
  SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS span FROM marked
),
spans AS (SELECT doc_id, span, min(i) AS a, max(i) + 200 AS b FROM numbered GROUP BY 1, 2),
before AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS z FROM spans),
cut AS (
  SELECT d.doc_id, coalesce(sum(b - a), 0) AS gone, count(a) AS n, coalesce(max(b), 0) AS z,
         coalesce(string_agg(substr(h, (1 + 2 * s.z)::BIGINT, (2 * (a - s.z))::BIGINT), '' ORDER BY a), '') AS head
  FROM d LEFT JOIN before s ON s.doc_id = d.doc_id GROUP BY d.doc_id
)
SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, gone::BIGINT AS n_removed, n::BIGINT AS n_spans,
       sha256(unhex(head || substr(h, (1 + 2 * z)::BIGINT))) AS kept_sha256
FROM d JOIN cut ON cut.doc_id = d.doc_id
"""

_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_inner_product(a.v, b.v)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
),
positive AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
),
ranked AS (
  SELECT p.anchor_id, positive_id, positive_score, s.other_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other_id) AS rank
  FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 5
"""

ORACLES: dict[str, str] = {
    "op3_warc": _WARC,
    "op7_jaccard_join": _JACCARD,
    "op10_suffix_dedup": _REPEATS,
    "op13_hard_negatives": _NEGATIVES,
}

"""The queries as DuckDB SQL over the same tables, for comparison."""

from __future__ import annotations

RATINGS = """
ratings AS (
  SELECT o_custkey::INTEGER AS userId, l_partkey::INTEGER AS productId,
         (l_quantity % 5) + 1 AS score, epoch(o_orderdate)::BIGINT AS timestamp,
         l_orderkey AS orderkey, l_linenumber AS linenumber
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

PRODUCTS = """
products AS (
  SELECT p_partkey::INTEGER AS productId, p_name AS name, 'part/' || p_partkey AS imageUrl,
         p_type AS categories,
         replace(p_name, ' ', '|') || '|' || p_brand || '|' || p_type AS tags
  FROM part
)"""

MEANS = "means AS (SELECT productId, avg(score) AS avg FROM ratings GROUP BY productId)"

ITEM_CF = """
counts AS (SELECT productId, count(*) AS n FROM ratings GROUP BY productId),
pairs AS (
  SELECT a.productId AS product1, b.productId AS product2, count(*) AS cocount
  FROM ratings a JOIN ratings b ON a.userId = b.userId AND a.productId <> b.productId
  GROUP BY 1, 2
),
alike AS (
  SELECT product1, product2, cocount, x.n AS count1, y.n AS count2,
         round(cocount / sqrt(x.n::DOUBLE * y.n::DOUBLE), 6) AS sim
  FROM pairs JOIN counts x ON x.productId = product1 JOIN counts y ON y.productId = product2
),
itemcf AS (
  SELECT product1 AS productId, product2 AS recProductId, sim AS score,
         (row_number() OVER (PARTITION BY product1 ORDER BY sim DESC, product2))::INTEGER AS rank
  FROM alike QUALIFY rank <= 10
)"""

WEIGHTS = """
words AS (
  SELECT productId, unnest(string_split(lower(replace(tags, '|', ' ')), ' ')) AS term FROM products
),
counted AS (SELECT productId, term, count(*)::INTEGER AS tf FROM words GROUP BY 1, 2),
total AS (SELECT count(*) AS n FROM products),
spread AS (SELECT term, count(*) AS df FROM counted GROUP BY 1),
inverse AS (SELECT term, df, ln((n + 1) / (df + 1)) AS idf FROM spread, total),
weights AS (
  SELECT productId, c.term, tf, df, idf, tf * idf AS weight
  FROM counted c JOIN inverse s ON c.term = s.term
)"""

CONTENT = """
norms AS (SELECT productId, sqrt(sum(weight * weight)) AS size FROM weights GROUP BY 1),
units AS (
  SELECT w.productId, term, weight / size AS u
  FROM weights w JOIN norms n ON w.productId = n.productId WHERE size > 0
),
content AS (
  SELECT a.productId AS productId, b.productId AS recProductId, round(sum(a.u * b.u), 6) AS score
  FROM units a JOIN units b ON a.term = b.term AND a.productId <> b.productId
  GROUP BY 1, 2 HAVING round(sum(a.u * b.u), 6) > 0.4
)"""

CONTENT_TOP = """
content_top AS (
  SELECT productId, recProductId, score,
         (row_number() OVER (PARTITION BY productId ORDER BY score DESC, recProductId))::INTEGER AS rank
  FROM content QUALIFY rank <= 20
)"""

LATEST = """
latest AS (
  SELECT *, (row_number() OVER (PARTITION BY userId ORDER BY timestamp DESC, orderkey DESC,
             linenumber DESC, productId DESC, score DESC))::INTEGER AS seq
  FROM ratings
)"""

CANDIDATES = """
candidates AS (
  SELECT e.userId, c.recProductId AS candidate, c.score,
         (row_number() OVER (PARTITION BY e.userId ORDER BY c.score DESC, c.recProductId))::INTEGER AS rank
  FROM latest e JOIN content c ON e.productId = c.productId
  WHERE e.seq = 1 AND NOT EXISTS (
    SELECT 1 FROM ratings r WHERE r.userId = e.userId AND r.productId = c.recProductId)
  QUALIFY rank <= 20
)"""

STREAM = """
scored AS (
  SELECT k.userId, k.candidate, sum(round(c.score * 1e6) * r.score) / count(*) / 1e6 AS base,
         count(*) FILTER (r.score > 3) AS high, count(*) FILTER (r.score <= 3) AS low
  FROM candidates k JOIN latest r ON r.userId = k.userId AND r.seq <= 21
  JOIN content c ON c.productId = k.candidate AND c.recProductId = r.productId
  GROUP BY 1, 2
),
listed AS (
  SELECT userId, candidate,
         round(base + log10(greatest(high, 1)) - log10(greatest(low, 1)), 6) AS score
  FROM scored
),
lists AS (
  SELECT u.userId, count(s.candidate)::INTEGER AS entries,
         coalesce(string_agg(s.candidate || ':' || round(s.score * 1e6)::BIGINT, ','
                  ORDER BY s.score DESC, s.candidate), '') AS recs
  FROM (SELECT DISTINCT userId FROM candidates) u
  LEFT JOIN listed s ON s.userId = u.userId GROUP BY 1
)"""



def _batch_lists(newest: int) -> str:
    """The lists after the batch whose events are the ratings of this place, counted from the newest."""
    cands = CANDIDATES.replace("e.seq = 1", f"e.seq = {newest}").replace(
        "FROM ratings r WHERE r.userId", f"FROM latest r WHERE r.seq >= {newest} AND r.userId"
    )
    lists = STREAM.replace("r.seq <= 21", f"r.seq BETWEEN {newest} AND {newest + 20}")
    text = cands.strip() + ", " + lists.strip()
    for name in ("candidates", "scored", "listed", "lists"):
        text = text.replace(f"{name} AS (", f"{name}{newest} AS (").replace(f"FROM {name} ", f"FROM {name}{newest} ")
    return text.replace("FROM candidates)", f"FROM candidates{newest})").replace("FROM scored\n", f"FROM scored{newest}\n").replace(
        "LEFT JOIN listed s", f"LEFT JOIN listed{newest} s")


COSINES = """
items AS (
  SELECT vec_id::INTEGER AS id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
),
unit AS (SELECT id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS size FROM items),
cosines AS (
  SELECT a.id AS productId, b.id AS recProductId,
         round(list_inner_product(a.v, b.v) / (a.size * b.size), 6) AS score
  FROM unit a JOIN unit b ON a.id <> b.id WHERE a.size > 0 AND b.size > 0
)"""

LOG = """
rated AS (
  SELECT 'PRODUCT_RATING_PREFIX:' || o_custkey || '|' || l_partkey || '|' || ((l_quantity % 5) + 1)
         AS head, epoch(o_orderdate)::BIGINT AS seen, l_returnflag
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
log AS (
  SELECT head || '|' || seen AS value FROM rated WHERE l_returnflag = 'N'
  UNION ALL SELECT 'INFO rating ' || head || '|' || seen || ' ' || chr(9) FROM rated WHERE l_returnflag = 'A'
  UNION ALL SELECT head FROM rated WHERE l_returnflag IS NULL OR l_returnflag NOT IN ('N', 'A')
  UNION ALL SELECT text FROM documents
),
messages AS (
  SELECT trim(split_part(value, 'PRODUCT_RATING_PREFIX:', 2), ' ' || chr(9)) AS value
  FROM log WHERE contains(value, 'PRODUCT_RATING_PREFIX:')
),
fields AS (
  SELECT value, string_split(value, '|') AS f,
         TRY_CAST(f[1] AS INTEGER) AS userId, TRY_CAST(f[2] AS INTEGER) AS productId,
         TRY_CAST(f[3] AS DOUBLE) AS score, TRY_CAST(f[4] AS BIGINT) AS timestamp
  FROM messages
)"""

COMPLETE = "userId IS NOT NULL AND productId IS NOT NULL AND score IS NOT NULL AND timestamp IS NOT NULL"

SPLIT = """
drawn AS (
  SELECT *, ('0x' || substr(md5('42|' || userId || '|' || productId || '|' || timestamp), 1, 8))::BIGINT
            / 4294967296.0 < 0.8 AS train
  FROM ratings
)"""


def _with(*parts: str, select: str) -> str:
    return "WITH " + ", ".join(p.strip() for p in parts) + " " + select


def _hydrated(recs: str, columns: str) -> str:
    return f"""SELECT {columns}, p.productId AS recProductId, p.name, round(coalesce(m.avg, 0), 6) AS avg
               FROM {recs} r JOIN products p ON p.productId = r.recProductId
               LEFT JOIN means m ON m.productId = r.recProductId"""


_CONTENT = (PRODUCTS, WEIGHTS, CONTENT)
_VECTOR_TOP = _with(COSINES, select="""
    SELECT productId, recProductId, score,
           (row_number() OVER (PARTITION BY productId ORDER BY score DESC, recProductId))::INTEGER AS rank
    FROM cosines WHERE score > 0.1 QUALIFY rank <= 5""")
_STREAM_LISTS = _with(
    RATINGS, *_CONTENT, LATEST, CANDIDATES, STREAM, select="SELECT userId, entries, recs FROM lists"
)

ORACLES: dict[str, str] = {
    "rate_more": _with(RATINGS, select="SELECT productId, count(*) AS count FROM ratings GROUP BY 1"),
    "rate_recent": _with(RATINGS, select="""
        SELECT productId, count(*) AS count,
               strftime(to_timestamp(timestamp) AT TIME ZONE 'UTC', '%Y%m')::INTEGER AS yearMonth
        FROM ratings GROUP BY 1, 3"""),
    "average_score": _with(RATINGS, MEANS, select="SELECT productId, round(avg, 6) AS avg FROM means"),
    "top_rated_products": _with(RATINGS, PRODUCTS, MEANS, """
        top AS (SELECT productId AS recProductId, count(*) AS count FROM ratings GROUP BY 1
                ORDER BY count DESC, productId LIMIT 20)""", select=_hydrated("top", "r.count")),
    "hot_products": _with(RATINGS, PRODUCTS, MEANS, """
        hot AS (SELECT productId AS recProductId, count(*) AS count,
                       strftime(to_timestamp(timestamp) AT TIME ZONE 'UTC', '%Y%m')::INTEGER AS yearMonth
                FROM ratings GROUP BY 1, 3 ORDER BY yearMonth DESC, count DESC, productId LIMIT 20)""",
        select=_hydrated("hot", "r.yearMonth, r.count")),
    "distinct_users_products": _with(RATINGS, select="""
        SELECT 'user' AS kind, userId AS id FROM ratings GROUP BY userId
        UNION ALL SELECT 'product', productId FROM ratings GROUP BY productId"""),
    "cooccurrence": _with(RATINGS, ITEM_CF, select="""
        SELECT product1, product2, cocount, count1, count2, sim FROM alike"""),
    "itemcf_topk": _with(RATINGS, ITEM_CF, select="SELECT productId, recProductId, score, rank FROM itemcf"),
    "itemcf_lists": _with(RATINGS, PRODUCTS, ITEM_CF, select="""
        SELECT p.productId, count(i.rank)::INTEGER AS entries,
               coalesce(string_agg(i.recProductId || ':' || round(i.score * 1e6)::BIGINT, ',' ORDER BY i.rank), '')
               AS recs
        FROM products p LEFT JOIN itemcf i ON i.productId = p.productId GROUP BY 1"""),
    "tfidf_weights": _with(PRODUCTS, WEIGHTS, select="""
        SELECT productId, term, tf, df, round(idf, 6) AS idf, round(weight, 6) AS weight FROM weights"""),
    "content_sim": _with(*_CONTENT, select="SELECT productId, recProductId, score FROM content"),
    "content_topk": _with(*_CONTENT, CONTENT_TOP, select="""
        SELECT productId, recProductId, score, rank FROM content_top"""),
    "content_hashed": _with(PRODUCTS, WEIGHTS.replace(
        "unnest(string_split(lower(replace(tags, '|', ' ')), ' '))",
        "('0x' || substr(md5(unnest(string_split(lower(replace(tags, '|', ' ')), ' '))), 1, 8))::BIGINT % 800",
    ), CONTENT, CONTENT_TOP, select="SELECT productId, recProductId, score, rank FROM content_top"),
    "als_fit_check": _with(RATINGS, select="""
        SELECT userId, count(*) AS ratings, true AS solved FROM ratings GROUP BY 1"""),
    "als_lists_check": _with(RATINGS, select="""
        SELECT DISTINCT userId, true AS ranked, true AS falling, true AS "right" FROM ratings"""),
    "als_holdout": _with(RATINGS, SPLIT, select="""
        SELECT userId, productId, score, timestamp, true AS predicted FROM drawn
        WHERE NOT train AND userId IN (SELECT userId FROM drawn WHERE train)
          AND productId IN (SELECT productId FROM drawn WHERE train)"""),
    "als_grid": """
        SELECT r.rank, l."lambda", true AS number, true AS best_better
        FROM (VALUES (5), (10), (20), (50)) r(rank), (VALUES (0.01::DOUBLE), (0.1::DOUBLE), (1.0::DOUBLE)) l("lambda")""",
    "vector_sim": _with(COSINES, select="SELECT productId, recProductId, score FROM cosines WHERE score > 0.4"),
    "vector_topk": _VECTOR_TOP,
    "vector_topk_blocks": _VECTOR_TOP,
    "mips_topk": _with(COSINES, """
        stretched AS (SELECT id, list_transform(v, lambda x: x * (1 + id % 7)) AS v FROM items)""", select="""
        SELECT a.id AS vecId, b.id AS otherId, round(list_inner_product(a.v, b.v), 6) AS score,
               (row_number() OVER (PARTITION BY a.id ORDER BY round(list_inner_product(a.v, b.v), 6) DESC, b.id))::INTEGER AS rank
        FROM stretched a, stretched b QUALIFY rank <= 20"""),
    "rating_split": _with(RATINGS, SPLIT, select="""
        SELECT userId, CASE WHEN train THEN 'train' ELSE 'test' END AS side,
               count(*) AS ratings, sum(score) AS total
        FROM drawn GROUP BY 1, 2"""),
    "rmse": _with(RATINGS, SPLIT, select="""
        SELECT round(sqrt(avg((t.score - m.prediction) * (t.score - m.prediction))), 6) AS rmse
        FROM drawn t JOIN (SELECT productId, avg(score) AS prediction FROM drawn WHERE train GROUP BY 1) m
          ON m.productId = t.productId
        WHERE NOT t.train"""),
    "latest_ratings": _with(RATINGS, LATEST, select="""
        SELECT userId, seq, productId, score, timestamp FROM latest WHERE seq <= 21"""),
    "stream_queue": _with(RATINGS, LATEST, select="""
        SELECT userId, seq, productId, score FROM latest WHERE seq <= 40"""),
    "stream_from_position": _with(RATINGS, select="""
        SELECT userId, productId, score::DOUBLE AS score, timestamp FROM ratings WHERE linenumber > 1"""),
    "rating_documents": _with(RATINGS, select="""
        SELECT userId, productId, score::DOUBLE AS score, timestamp FROM ratings WHERE userId % 11 <> 0"""),
    "rejected_rating_documents": _with(RATINGS, select="""
        SELECT '{"userId":' || userId || ',"productId":' || productId || ',"score":' || score::DOUBLE
               || ',"timestamp":' || timestamp AS value FROM ratings WHERE userId % 11 = 0"""),
    "fold_in": _with(RATINGS, COSINES, """
        sums AS (
          SELECT userId, count(*) AS n, sum(v[1] * v[1]) AS a, sum(v[1] * v[2]) AS b, sum(v[2] * v[2]) AS c,
                 sum(v[1] * score) AS x, sum(v[2] * score) AS y
          FROM ratings JOIN items ON id = productId GROUP BY 1
        ),
        equations AS (SELECT userId, n, a + 0.01 * n AS a, b, c + 0.01 * n AS c, x, y FROM sums)""", select="""
        SELECT userId, n AS ratings, round((c * x - b * y) / (a * c - b * b), 6) AS u1,
               round((a * y - b * x) / (a * c - b * b), 6) AS u2 FROM equations"""),
    "product_search_indexed": _with(RATINGS, PRODUCTS, MEANS, select="""
        SELECT p.productId, name, imageUrl, categories, tags, round(coalesce(m.avg, 0), 6) AS avg
        FROM products p LEFT JOIN means m ON m.productId = p.productId
        WHERE regexp_matches(name, 'ring|lemon.*(green|blue)|hot( |$)')"""),
    "rating_queue": _with(RATINGS, LATEST, select="""
        SELECT userId, seq, productId, score FROM latest WHERE seq <= 40"""),
    "rating_upsert": _with(RATINGS, LATEST, select="""
        SELECT h.userId, h.productId, h.score, h.timestamp FROM latest h
        WHERE h.seq > 1 AND NOT EXISTS (SELECT 1 FROM latest e
          WHERE e.seq = 1 AND e.userId = h.userId AND e.productId = h.productId)
        UNION ALL
        SELECT e.userId, e.productId, e.score, coalesce((SELECT min(h.timestamp) FROM latest h
          WHERE h.seq > 1 AND h.userId = e.userId AND h.productId = e.productId), e.timestamp)
        FROM latest e WHERE e.seq = 1"""),
    "stream_candidates": _with(RATINGS, *_CONTENT, LATEST, CANDIDATES, select="""
        SELECT userId, candidate, score, rank FROM candidates"""),
    "stream_scores": _STREAM_LISTS,
    "stream_replay": _STREAM_LISTS,
    "stream_two_batches": _with(RATINGS, *_CONTENT, LATEST, _batch_lists(2), _batch_lists(1), """
        final AS (
          SELECT * FROM lists1 UNION ALL
          SELECT * FROM lists2 WHERE userId NOT IN (SELECT userId FROM lists1)
        ),
        entries AS (
          SELECT userId, unnest(string_split(recs, ',')) AS entry,
                 generate_subscripts(string_split(recs, ','), 1)::INTEGER AS rank
          FROM final WHERE recs <> ''
        )""", select="""
        SELECT userId, split_part(entry, ':', 1)::INTEGER AS recProductId, rank,
               split_part(entry, ':', 2)::BIGINT AS score
        FROM entries WHERE rank <= 5"""),
    "user_recs_lookup": _with(RATINGS, select="""
        SELECT userId, r.rank FROM (SELECT DISTINCT userId FROM ratings),
               (SELECT unnest(range(1, 6))::INTEGER AS rank) r"""),
    "registrations": """
        WITH names AS (
          SELECT c_name AS username FROM orders JOIN customer ON o_custkey = c_custkey
          UNION SELECT s_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
        ),
        fresh AS (SELECT username FROM names WHERE username NOT IN (SELECT c_name FROM customer)),
        hashed AS (
          SELECT username, list_reduce(
            list_prepend(0::BIGINT, list_transform(string_split(username, ''), lambda c: unicode(c)::BIGINT)),
            lambda h, c: (h * 31 + c) & 4294967295) AS h
          FROM fresh
        )
        SELECT (CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END)::INTEGER AS userId, username,
               true AS first, 1700000000::BIGINT AS timestamp, 0 AS genres
        FROM hashed""",
    "preference_update": _with(RATINGS, select="""
        SELECT c_custkey::INTEGER AS userId, c_name AS username,
               CASE WHEN r.userId IS NULL THEN false ELSE c_acctbal > 0 END AS first,
               CASE WHEN r.userId IS NULL THEN '' ELSE c_mktsegment || ',' || n_name END AS prefGenres
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN (SELECT DISTINCT userId FROM ratings) r ON r.userId = c_custkey"""),
    "parse_rating_log": _with(LOG, select=f"""
        SELECT userId, productId, score, timestamp FROM fields WHERE {COMPLETE}"""),
    "rejected_rating_log": _with(LOG, select=f"SELECT value FROM fields WHERE NOT ({COMPLETE})"),
    "format_rating_log": _with(RATINGS, select="""
        SELECT 'PRODUCT_RATING_PREFIX:' || userId || '|' || productId || '|' || score || '|' || timestamp AS value
        FROM ratings"""),
    "load_products": _with(PRODUCTS, select="""
        SELECT productId, '"' || name AS name, imageUrl, categories, tags FROM products"""),
    "load_ratings": _with(RATINGS, select="SELECT userId, productId, score, timestamp FROM ratings"),
    "recs_lookup": _with(RATINGS, PRODUCTS, MEANS, ITEM_CF, select=_hydrated(
        "(SELECT * FROM itemcf WHERE rank <= 5)", "r.productId, r.rank, r.score")),
    "bucketed_lookup": _with(RATINGS, PRODUCTS, MEANS, ITEM_CF, select="""
        SELECT p.productId, name, round(coalesce(m.avg, 0), 6) AS avg, i.recProductId, i.rank, i.score
        FROM products p LEFT JOIN means m ON m.productId = p.productId JOIN itemcf i ON i.productId = p.productId"""),
    "content_lookup": _with(RATINGS, *_CONTENT, CONTENT_TOP, MEANS, select=_hydrated(
        "(SELECT * FROM content_top WHERE rank <= 5 AND productId IN (SELECT productId FROM ratings))",
        "r.productId, r.rank, r.score")),
    "recs_by_username": _with(RATINGS, *_CONTENT, LATEST, CANDIDATES, MEANS, select=_hydrated(
        """(SELECT c_name AS username, rank, score, candidate AS recProductId
            FROM candidates JOIN customer ON c_custkey = userId WHERE rank <= 5)""",
        "r.username, r.rank, r.score")),
    "product_search": _with(RATINGS, PRODUCTS, MEANS, select="""
        SELECT p.productId, name, imageUrl, categories, tags, round(coalesce(m.avg, 0), 6) AS avg
        FROM products p LEFT JOIN means m ON m.productId = p.productId
        WHERE regexp_matches(name, 'ring|ge[a-z]r')"""),
    "product_info": _with(RATINGS, PRODUCTS, MEANS, select="""
        SELECT p.productId, name, imageUrl, categories, tags, round(m.avg, 6) AS avg
        FROM products p JOIN means m ON m.productId = p.productId"""),
    "user_by_name": """
        SELECT c_custkey::INTEGER AS userId, c_name AS username, false AS first FROM customer
        WHERE c_name IN (SELECT c_name FROM customer UNION SELECT s_name FROM supplier)""",
    "score_scale": """
        SELECT l_orderkey AS orderkey, l_linenumber AS linenumber,
               round(((l_quantity % 10) + 1) / 2, 2) AS score FROM lineitem""",
    "user_hash": """
        WITH hashed AS (
          SELECT c_name, list_reduce(
            list_prepend(0::BIGINT, list_transform(string_split(c_name, ''), lambda c: unicode(c)::BIGINT)),
            lambda h, c: (h * 31 + c) & 4294967295) AS h
          FROM customer
        )
        SELECT c_name AS username,
               (CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END)::INTEGER AS userId
        FROM hashed""",
}

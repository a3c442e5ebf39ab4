"""SQL that DuckDB checks the queries against, where SQL can express them."""

from __future__ import annotations

# The URL rules written out: the longest that fits decides.
_URLS = r"""
WITH split AS (
  SELECT page_id,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1, 's'),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM split
), judged AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/'
  END AS rule
  FROM parts
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""

# All scores, then the ten best of each query.
_TOP = """
WITH rows AS (
  SELECT vec_id, row_number() OVER () AS r, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.r AS query, q.vec_id AS query_id, c.r AS r, c.vec_id AS vec_id,
         CAST(list_sum([p[1] * p[2] for p in list_zip(q.v, c.v)]) AS BIGINT) AS score
  FROM rows q JOIN rows c ON q.r <> c.r
  WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id, r) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

# All pairs that share a shingle, and everything that links reach.
_JACCARD = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i : i + 4], ' ') for i in range(1, len(w) - 3)]) END AS s
  FROM words
), items AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach AS (
  SELECT a, b FROM pairs UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON reach.b = pairs.a
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles,
       least(doc_id, coalesce((SELECT min(b) FROM reach WHERE reach.a = doc_id), doc_id)) AS component_id
FROM sets
"""

ORACLES = {"op4_topk_search": _TOP, "op10_jaccard_join": _JACCARD, "op8_url_filters": _URLS}

"""DuckDB SQL for the queries that SQL can express."""

EXACT_DEDUP = r"""
WITH norm AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), groups AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM norm GROUP BY text_sha256
)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, n.text_sha256
FROM norm n JOIN groups g ON n.text_sha256 = g.text_sha256
"""

JACCARD = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words
), incidence AS (SELECT doc_id, unnest(s) AS g FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM incidence a JOIN incidence b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
  WHERE 100 * c >= 80 * (len(x.s) + len(y.s) - c)
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, m.component_id
FROM sets s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) m ON m.a = s.doc_id
"""

ORACLES = {"op6_ngram_jaccard": JACCARD, "op8_exact_dedup": EXACT_DEDUP}

WITH whole AS (
  SELECT vec_id, CAST(label AS BIGINT) AS label,
    CASE WHEN len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      THEN list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) END AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL),
r AS (
  SELECT vec_id, v, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    row_number() OVER () AS k
  FROM whole WHERE v IS NOT NULL),
scored AS (
  SELECT a.k AS anchor, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike,
    CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM r a JOIN r c ON len(a.v) = len(c.v) AND a.k <> c.k
  WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor, anchor_id, vec_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS p
  FROM scored WHERE alike QUALIFY p <= 5)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor, p.p ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
  n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON p.anchor = n.anchor AND NOT n.alike
  AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
QUALIFY rank <= 10

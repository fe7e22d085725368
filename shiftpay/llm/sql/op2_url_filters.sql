WITH captures AS (
  SELECT page_id, url,
    DATE '2024-01-01'
      + CAST(('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 6))::BIGINT % 365 AS INTEGER) AS fetched,
    nullif(regexp_replace(regexp_extract(lower(url),
      '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '\.+$', ''), '') AS host
  FROM pages),
hosts AS (SELECT DISTINCT host FROM captures WHERE host IS NOT NULL),
patterns AS (
  SELECT host AS pattern FROM hosts
  UNION
  SELECT array_to_string(string_split(host, '.')[-2:], '.') FROM hosts),
entries AS (
  SELECT pattern,
    ['block', 'allow', 'remove'][
      ('0x' || substr(md5(pattern || ':' || n), 7, 6))::BIGINT % 3 + 1] AS action,
    DATE '2024-01-01'
      + CAST(('0x' || substr(md5(pattern || ':' || n), 1, 6))::BIGINT % 365 AS INTEGER) AS dated
  FROM patterns, unnest([1, 2, 3]) AS t(n)
  WHERE ('0x' || substr(md5(pattern), 7, 6))::BIGINT % 2 = 0),
daily AS (
  SELECT pattern, dated,
    min(CASE action WHEN 'block' THEN 1 WHEN 'allow' THEN 2 ELSE 3 END) AS rank
  FROM entries GROUP BY 1, 2),
spans AS (
  SELECT pattern, ['block', 'allow', 'remove'][rank] AS action, dated AS valid_from,
    lead(dated) OVER (PARTITION BY pattern ORDER BY dated) AS valid_to
  FROM daily),
wanted AS (
  SELECT host, fetched,
    unnest(list_transform(range(1, greatest(len(string_split(host, '.')), 2)),
      lambda i: array_to_string(string_split(host, '.')[i:], '.'))) AS pattern
  FROM (SELECT DISTINCT host, fetched FROM captures WHERE host IS NOT NULL)),
found AS (
  SELECT w.host, w.fetched, s.pattern, s.action, s.valid_from, s.valid_to
  FROM wanted w ASOF JOIN spans s ON w.pattern = s.pattern AND w.fetched >= s.valid_from),
best AS (
  SELECT * FROM found WHERE action <> 'remove'
  QUALIFY row_number() OVER (PARTITION BY host, fetched ORDER BY length(pattern) DESC) = 1)
SELECT c.page_id, c.url, c.fetched, c.host, b.pattern, b.action, b.valid_from, b.valid_to,
  NOT coalesce(b.action = 'block', false) AS kept
FROM captures c LEFT JOIN best b ON c.host = b.host AND c.fetched = b.fetched

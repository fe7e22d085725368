WITH docs AS (SELECT doc_id AS id, coalesce(text, '') AS text FROM documents),
cut AS (
  SELECT id, text, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) - 1 AS place
  FROM docs),
words AS (
  SELECT id, text, place,
    list_filter(string_split_regex(
      regexp_replace(line, '[^ \t\x0B\f\r]*[0-9][^ \t\x0B\f\r]*', '<*>', 'g'), '[ \t\x0B\f\r]+'),
      lambda x: x <> '') AS tokens
  FROM cut),
measured AS (
  SELECT *, len(tokens) AS n, tokens[1:4] AS lead,
    strlen(replace(replace(array_to_string(tokens, ' '), '<*>', ''), ' ', '')) AS size,
    (strlen(array_to_string(tokens, ' ')) - strlen(replace(array_to_string(tokens, ' '), '<*>', ''))) / 3 AS wild
  FROM words),
lines AS (
  SELECT id, text, place, tokens, n, lead,
    CASE WHEN n >= 50 OR (n <= 4 AND size >= 300) THEN 2 WHEN n >= 3 OR size >= 24 THEN 3 ELSE 10 END AS need
  FROM measured WHERE size >= 8 AND (wild = 0 OR n - wild >= 2)),
texts AS (
  SELECT n, lead, tokens, need, text, min(CASE WHEN id IS NULL THEN 9223372036854775807 ELSE id END) AS first
  FROM lines GROUP BY ALL),
kinds AS (SELECT n, lead, tokens, need, count(*) AS texts FROM texts GROUP BY ALL),
places AS (
  SELECT n, lead, tokens, need, texts, unnest(tokens[5:]) AS token, generate_subscripts(tokens[5:], 1) AS spot
  FROM kinds),
supported AS (
  SELECT n, lead, spot, token, sum(texts) AS support FROM places
  WHERE token <> '<*>' GROUP BY n, lead, spot, token, need HAVING sum(texts) >= need),
found AS (
  SELECT p.n, p.lead, p.tokens, count(*) AS spots, count_if(p.token <> '<*>') AS words,
    list({'spot': p.spot, 'token': p.token} ORDER BY s.support DESC, p.spot)
      FILTER (WHERE s.support IS NOT NULL) AS found
  FROM places p LEFT JOIN supported s ON p.n = s.n AND p.lead = s.lead AND p.spot = s.spot AND p.token = s.token
  GROUP BY p.n, p.lead, p.tokens),
wanted AS (
  SELECT *, least(words, greatest(ceil(spots * 0.7::DOUBLE), 2))::INT AS wanted FROM found),
templates AS (
  SELECT n, lead, tokens, list_sort(coalesce(found, [])[1:wanted]) AS template
  FROM wanted WHERE coalesce(len(found), 0) >= wanted
  UNION ALL SELECT n, lead, tokens, [] FROM kinds WHERE n <= 4),
held AS (
  SELECT n, lead, template, need, text, min(first) AS first
  FROM texts JOIN templates USING (n, lead, tokens) GROUP BY ALL),
counted AS (
  SELECT n, lead, template, min(first) AS first, arg_min(text, (first, text)) AS first_text
  FROM held GROUP BY n, lead, template, need HAVING count(*) >= need),
recurring AS (
  SELECT n, lead, tokens, first, first_text FROM templates JOIN counted USING (n, lead, template)),
gone AS (
  SELECT DISTINCT l.id, l.text, l.place
  FROM lines l JOIN recurring r USING (n, lead, tokens)
  WHERE NOT (coalesce(l.id, 9223372036854775807) = r.first AND l.text = r.first_text)),
each_row AS (
  SELECT d.doc_id, d.text, len(string_split(d.text, chr(10))) AS n_lines,
    (SELECT list(g.place) FROM gone g
     WHERE g.id IS NOT DISTINCT FROM d.doc_id AND g.text = coalesce(d.text, '')) AS places
  FROM documents d),
left_over AS (
  SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(len(places), 0) AS n_dropped,
    CASE WHEN places IS NULL THEN text ELSE array_to_string(list_filter(
      string_split(text, chr(10)), lambda x, i: NOT list_contains(places, i - 1)), chr(10)) END AS text
  FROM each_row)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_dropped AS BIGINT) AS n_dropped,
  CAST(length(text) AS BIGINT) AS n_chars_left, md5(text) AS text_md5
FROM left_over

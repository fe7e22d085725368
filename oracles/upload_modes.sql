SELECT CAST(step AS BIGINT) AS step, mode, CASE step WHEN 0 THEN everybody WHEN 1 THEN everybody + active ELSE active END AS row_count
FROM (SELECT count(*) AS everybody, count(*) FILTER (WHERE status = 'Active') AS active FROM employees),
     (VALUES (0, 'WRITE_EMPTY'), (1, 'WRITE_APPEND'), (2, 'WRITE_TRUNCATE')) AS m(step, mode)

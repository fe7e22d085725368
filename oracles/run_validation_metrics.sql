SELECT count(*) AS records_in, count(*) FILTER (WHERE error_reason IS NULL) AS clean_records,
       count(error_reason) AS flagged_records,
       CAST((2 * count(error_reason) * 10000 + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS error_rate_pct
FROM validated

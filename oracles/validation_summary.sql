, counts AS (SELECT error_reason, count(*) AS "count" FROM validated WHERE error_reason IS NOT NULL GROUP BY 1),
whole AS (SELECT CAST(sum("count") AS BIGINT) AS total_errors FROM counts)
SELECT error_reason, "count",
       CAST((2 * "count" * 10000 + total_errors) // (2 * total_errors) AS DOUBLE) / 100 AS percentage,
       total_errors
FROM counts, whole

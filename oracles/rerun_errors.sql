, known AS (SELECT DISTINCT log_id FROM judged WHERE k1 % 2 = 0),
met AS (
    SELECT 1 AS batch_id, CASE WHEN nth_in_half > 1 THEN 'DUPLICATE_RECORD' ELSE own_reason END AS error_reason
    FROM judged WHERE k1 % 2 = 0
    UNION ALL
    SELECT 2, CASE WHEN nth_in_half > 1 THEN 'DUPLICATE_RECORD' ELSE own_reason END
    FROM judged WHERE log_id NOT IN (SELECT log_id FROM known)
)
SELECT CAST(batch_id AS BIGINT) AS batch_id, error_reason, count(*) AS errors
FROM met WHERE error_reason IS NOT NULL GROUP BY ALL

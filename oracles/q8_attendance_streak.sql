, days AS (SELECT DISTINCT employee_id, log_date FROM logs),
gaps AS (
  SELECT *, lag(log_date) OVER (PARTITION BY employee_id ORDER BY log_date) AS prev_date FROM days
)
SELECT employee_id, log_date, prev_date, log_date - prev_date AS gap_days,
       CASE WHEN prev_date IS NULL OR log_date - prev_date > 1 THEN 'NEW_STREAK' ELSE 'CONTINUING' END AS streak_status
FROM gaps

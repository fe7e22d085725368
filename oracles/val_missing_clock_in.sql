, holed AS (
    SELECT *, row_number() OVER (PARTITION BY log_id ORDER BY k1, k2, k3, k4, k5, clock_out NULLS FIRST) AS nth_holed
    FROM judged
)
SELECT log_id, employee_id, 'MISSING_CLOCK_IN' AS error_reason FROM holed
WHERE k1 % 9 = 0 AND nth_holed = 1 AND employee_id <> '' AND clock_out IS NOT NULL

, skewed AS (
    SELECT *, CASE WHEN k1 % 3 = 0 THEN 'LOG000000000' WHEN k1 % 7 = 1 THEN NULL ELSE log_id END AS skewed_id
    FROM judged
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY skewed_id ORDER BY clock_in, k1, k2, k3, k4, k5) AS skewed_nth
    FROM skewed
)
SELECT skewed_id AS log_id, employee_id, clock_in, clock_out, department, pay_rate, log_date,
       CASE WHEN skewed_nth > 1 THEN 'DUPLICATE_RECORD' ELSE own_reason END AS error_reason
FROM ranked

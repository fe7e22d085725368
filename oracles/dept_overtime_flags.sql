, flags AS (
  SELECT department, staff_n, h_c, gp_c, o_c * 1000 // h_c AS q, o_c * 1000 % h_c AS r FROM dept
),
rated AS (
  SELECT *, q + CASE WHEN 2 * r > h_c OR (2 * r = h_c AND q % 2 = 1) THEN 1 ELSE 0 END AS tenths FROM flags
)
SELECT department, staff_n AS total_employees, CAST(h_c AS DOUBLE) / 100 AS total_hours,
       CAST(gp_c AS DOUBLE) / 100 AS total_gross_pay, CAST(tenths AS DOUBLE) / 10 AS overtime_rate_pct,
       CASE WHEN tenths > 150 THEN 'HIGH OT' ELSE '' END AS flag
FROM rated

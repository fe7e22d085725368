SELECT department, staff_n AS headcount, CAST(gp_c AS DOUBLE) / 100 AS total_cost,
       avg_rate AS avg_pay_rate, ot_hours_pct AS ot_rate_pct
FROM dept_rates ORDER BY staff_n DESC, department LIMIT 10

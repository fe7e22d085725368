, chosen AS (SELECT * FROM payroll)
SELECT c.employee_id, week_start, c.department, CAST(h_c AS DOUBLE) / 100 AS total_hours,
       CAST(o_c AS DOUBLE) / 100 AS total_overtime, CAST(gp_c AS DOUBLE) / 100 AS total_gross_pay,
       CAST(shifts AS INT) AS num_shifts, 'weekly' AS pay_period,
       first_name || ' ' || last_name AS full_name, (SELECT count(*) FROM chosen) AS total
FROM chosen c JOIN employees e ON c.employee_id = e.employee_id
ORDER BY week_start DESC, gp_c DESC, c.employee_id, c.department 
LIMIT 500 OFFSET (SELECT greatest(0, (count(*) - 1) // 500 * 500) FROM payroll)

, weeks AS (
  SELECT week_start, sum(gp_c) AS gp_c, sum(op_c) AS op_c, sum(h4) AS h4, count(DISTINCT employee_id) AS staff_n
  FROM logs GROUP BY 1
)
SELECT week_start, CAST(gp_c AS DOUBLE) / 100 AS weekly_payroll,
       CAST(op_c AS DOUBLE) / 100 AS weekly_overtime_cost,
       CAST((h4 + 50) // 100 AS DOUBLE) / 100 AS weekly_hours,
       CAST(sum(gp_c) OVER (ORDER BY week_start) AS DOUBLE) / 100 AS cumulative_payroll,
       staff_n AS employees_paid
FROM weeks ORDER BY week_start DESC LIMIT 12

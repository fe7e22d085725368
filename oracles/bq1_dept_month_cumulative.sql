, months AS (
  SELECT department, CAST(date_trunc('month', log_date) AS DATE) AS pay_month,
         count(DISTINCT employee_id) AS active_employees, sum(h4) AS h4, sum(gp_c) AS gp_c
  FROM logs GROUP BY 1, 2
)
SELECT department, pay_month, active_employees, CAST((h4 + 50) // 100 AS DOUBLE) / 100 AS total_hours,
       CAST(gp_c AS DOUBLE) / 100 AS total_payroll,
       CAST(sum(gp_c) OVER (PARTITION BY department ORDER BY pay_month) AS DOUBLE) / 100 AS cumulative_dept_payroll
FROM months

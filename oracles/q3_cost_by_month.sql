SELECT department, CAST(date_trunc('month', log_date) AS DATE) AS pay_month,
       count(DISTINCT employee_id) AS active_employees,
       CAST((sum(h4) + 50) // 100 AS DOUBLE) / 100 AS total_hours,
       CAST(sum(gp_c) AS DOUBLE) / 100 AS total_payroll_cost,
       CAST((2 * sum(gp_c) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS avg_shift_cost,
       CAST((2 * sum(gp_c) * 10000 + sum(h4)) // (2 * sum(h4)) AS DOUBLE) / 100 AS effective_hourly_rate
FROM logs GROUP BY 1, 2

SELECT count(*) AS total_shifts, count(DISTINCT employee_id) AS total_employees,
       CAST((sum(h4) + 50) // 100 AS DOUBLE) / 100 AS total_hours,
       CAST((sum(o4) + 50) // 100 AS DOUBLE) / 100 AS overtime_hours,
       CAST(sum(gp_c) AS DOUBLE) / 100 AS total_payroll
FROM logs

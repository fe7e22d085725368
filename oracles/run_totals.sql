SELECT count(*) AS transformed_logs, CAST((sum(h4) + 50) // 100 AS DOUBLE) / 100 AS total_hours,
       CAST((sum(o4) + 50) // 100 AS DOUBLE) / 100 AS total_overtime_hours,
       CAST(sum(gp_c) AS DOUBLE) / 100 AS total_gross_pay
FROM logs

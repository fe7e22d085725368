SELECT department, count(DISTINCT employee_id) AS total_employees, count(log_id) AS total_shifts,
       CAST((sum(o4) + 50) // 100 AS DOUBLE) / 100 AS total_overtime_hours,
       CAST((2 * sum(o4) + count(*)) // (2 * count(*)) AS DOUBLE) / 10000 AS avg_overtime_per_shift,
       CAST(sum(op_c) AS DOUBLE) / 100 AS total_overtime_cost
FROM logs WHERE o4 > 0 GROUP BY department HAVING sum(o4) > 500000

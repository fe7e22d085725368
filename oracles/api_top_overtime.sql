SELECT e.employee_id, first_name || ' ' || last_name AS full_name, e.department, pay_rate,
       CAST((h4 + 50) // 100 AS DOUBLE) / 100 AS total_hours,
       CAST((o4 + 50) // 100 AS DOUBLE) / 100 AS total_overtime_hours,
       CAST(op_c AS DOUBLE) / 100 AS total_overtime_cost, rank() OVER (ORDER BY o4 DESC) AS overtime_rank
FROM employees e JOIN person p ON e.employee_id = p.employee_id
ORDER BY o4 DESC, e.employee_id LIMIT 25

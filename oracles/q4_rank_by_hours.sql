SELECT e.employee_id, first_name || ' ' || last_name AS full_name, department,
       CAST((h4 + 50) // 100 AS DOUBLE) / 100 AS total_hours,
       rank() OVER (ORDER BY h4 DESC) AS company_rank,
       dense_rank() OVER (PARTITION BY department ORDER BY h4 DESC) AS dept_rank,
       ntile(4) OVER (ORDER BY h4 DESC, e.employee_id) AS quartile
FROM employees e JOIN person p ON e.employee_id = p.employee_id

SELECT e.employee_id, first_name || ' ' || last_name AS full_name, department, shifts AS total_shifts,
       CAST((h4 + 50) // 100 AS DOUBLE) / 100 AS total_hours,
       CAST((o4 + 50) // 100 AS DOUBLE) / 100 AS total_overtime_hours,
       CAST(gp_c AS DOUBLE) / 100 AS total_gross_pay
FROM employees e JOIN person p ON e.employee_id = p.employee_id WHERE status = 'Active'
ORDER BY total_hours DESC

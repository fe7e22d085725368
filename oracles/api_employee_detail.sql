SELECT e.employee_id, first_name, last_name, department, pay_rate, hire_date, status, email,
       coalesce(shifts, 0) AS total_shifts, CAST((h4 + 50) // 100 AS DOUBLE) / 100 AS total_hours,
       CAST((o4 + 50) // 100 AS DOUBLE) / 100 AS total_overtime, CAST(gp_c AS DOUBLE) / 100 AS total_gross_pay
FROM employees e LEFT JOIN person p ON e.employee_id = p.employee_id WHERE e.employee_id = 'EMP0000001'

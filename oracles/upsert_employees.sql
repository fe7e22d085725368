SELECT employee_id, first_name, last_name, department, pay_rate, hire_date, status, email,
       CASE WHEN s_suppkey % 2 = 0 THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-02-01' END AS created_at,
       TIMESTAMP '2024-02-01' AS updated_at
FROM employees

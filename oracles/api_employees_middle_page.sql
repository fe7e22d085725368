, chosen AS (SELECT * FROM employees)
SELECT employee_id, first_name, last_name, department, pay_rate, hire_date, status, email,
       (SELECT count(*) FROM chosen) AS total
FROM chosen ORDER BY last_name, first_name, employee_id LIMIT 10 OFFSET 50

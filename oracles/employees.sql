SELECT employee_id, first_name, last_name, department, pay_rate, hire_date, status, email FROM employees

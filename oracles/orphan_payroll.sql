SELECT employee_id, week_start, department FROM payroll
WHERE employee_id NOT IN (SELECT employee_id FROM employees WHERE status = 'Active')

SELECT log_id, employee_id, clock_in FROM logs
WHERE employee_id NOT IN (SELECT employee_id FROM employees WHERE status = 'Active')

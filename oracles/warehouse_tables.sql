SELECT 'time_logs' AS table_name, employee_id, count(*) AS row_count FROM arrived_logs GROUP BY employee_id
UNION ALL
SELECT 'payroll_summary', employee_id, count(DISTINCT week_start) FROM arrived_logs GROUP BY employee_id
UNION ALL
SELECT 'employees', employee_id, 1 FROM employees

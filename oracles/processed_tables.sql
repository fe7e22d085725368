SELECT 'employees' AS table_name, count(*) AS row_count FROM employees
UNION ALL SELECT 'payroll_summary', count(*) FROM payroll
UNION ALL SELECT 'time_logs', count(*) FROM logs
UNION ALL SELECT 'errors', count(*) FROM validated WHERE error_reason IS NOT NULL
UNION ALL SELECT 'no_errors', 0

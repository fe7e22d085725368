, found AS (
  SELECT 'employees' AS table_name, 'email_unique' AS rule, count(*) AS violations
    FROM (SELECT email FROM employees GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'employees', 'employee_id_unique', count(*)
    FROM (SELECT employee_id FROM employees GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'employees', 'pay_rate_positive', count(*) FILTER (WHERE rate_c <= 0) FROM employees
  UNION ALL SELECT 'employees', 'status_known', count(*) FILTER (WHERE status NOT IN ('Active', 'Inactive', 'On Leave')) FROM employees
  UNION ALL SELECT 'raw_time_logs', 'employee_id_required', count(*) FILTER (WHERE employee_id IS NULL) FROM raw_logs
  UNION ALL SELECT 'raw_time_logs', 'clock_out_required', count(*) FILTER (WHERE clock_out IS NULL) FROM raw_logs
  UNION ALL SELECT 'raw_time_logs', 'department_required', count(*) FILTER (WHERE department IS NULL) FROM raw_logs
  UNION ALL SELECT 'raw_time_logs', 'clock_sequence', count(*) FILTER (WHERE clock_out <= clock_in) FROM raw_logs
  UNION ALL SELECT 'raw_time_logs', 'log_id_length', count(*) FILTER (WHERE length(log_id) > 12) FROM raw_logs
  UNION ALL SELECT 'raw_time_logs', 'log_id_unique', count(*)
    FROM (SELECT log_id FROM raw_logs GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'time_logs', 'log_id_unique', count(*)
    FROM (SELECT log_id FROM logs GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'time_logs', 'hours_worked_positive', count(*) FILTER (WHERE h4 <= 0) FROM logs
  UNION ALL SELECT 'payroll_summary', 'employee_id_week_start_unique', count(*)
    FROM (SELECT employee_id, week_start FROM payroll GROUP BY 1, 2 HAVING count(*) > 1)
)
SELECT * FROM found WHERE violations > 0

SELECT log_id, employee_id, clock_in, clock_out, department, pay_rate, log_date, error_reason, TIMESTAMP '2024-02-01' AS flagged_at, 'check' AS pipeline_run_id
FROM validated WHERE error_reason IS NOT NULL

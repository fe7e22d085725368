SELECT log_id, nullif(employee_id, '') AS employee_id, clock_in, clock_out, department, pay_rate, log_date FROM raw_logs

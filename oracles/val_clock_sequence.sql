SELECT log_id, employee_id, clock_in, clock_out, department, pay_rate, log_date, error_reason FROM validated WHERE error_reason = 'INVALID_CLOCK_SEQUENCE'

SELECT log_id, employee_id, clock_in, clock_out, department, pay_rate, log_date FROM clean

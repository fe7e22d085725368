SELECT log_id, employee_id, clock_in, clock_out, department, pay_rate, log_date,
       CAST(h4 AS DOUBLE) / 10000 AS hours_worked, CAST(o4 AS DOUBLE) / 10000 AS overtime_hours,
       CAST(r4 AS DOUBLE) / 10000 AS regular_hours, CAST(rp_c AS DOUBLE) / 100 AS regular_pay,
       CAST(op_c AS DOUBLE) / 100 AS overtime_pay, CAST(gp_c AS DOUBLE) / 100 AS gross_pay
FROM logs WHERE log_id NOT IN (SELECT log_id FROM early_logs)

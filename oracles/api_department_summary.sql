SELECT department, staff_n AS total_employees, CAST(h_c AS DOUBLE) / 100 AS total_hours,
       CAST(o_c AS DOUBLE) / 100 AS total_overtime_hours, CAST(gp_c AS DOUBLE) / 100 AS total_gross_pay,
       avg_rate AS avg_pay_rate, eff_rate AS effective_hourly_rate
FROM dept_rates

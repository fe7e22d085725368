SELECT employee_id, week_start, department, CAST(h_c AS DOUBLE) / 100 AS total_hours,
       CAST(o_c AS DOUBLE) / 100 AS total_overtime, CAST(gp_c AS DOUBLE) / 100 AS total_gross_pay,
       CAST(shifts AS INT) AS num_shifts, 'weekly' AS pay_period
FROM payroll

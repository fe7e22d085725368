SELECT department, ot_shifts AS overtime_shifts, CAST(o_c AS DOUBLE) / 100 AS total_overtime_hours,
       CAST(op_c AS DOUBLE) / 100 AS total_overtime_cost, ot_shift_pct AS overtime_rate_pct,
       ot_shift_pct > 20 AS severe, CAST(sum(o_c) OVER () AS DOUBLE) / 100 AS company_overtime_hours,
       CAST(sum(op_c) OVER () AS DOUBLE) / 100 AS company_overtime_cost
FROM dept_rates

SELECT department, shifts AS total_shifts, ot_shifts AS overtime_shifts,
       CAST(o_c AS DOUBLE) / 100 AS total_overtime_hours, avg_ot AS avg_overtime_per_shift,
       CAST(op_c AS DOUBLE) / 100 AS total_overtime_cost, ot_shift_pct AS overtime_rate_pct,
       ot_cost_pct AS overtime_cost_pct
FROM dept_rates

SELECT department, shifts AS total_shifts, ot_shifts AS overtime_shifts,
       ot_shift_pct AS overtime_rate_pct, ot_cost_pct AS overtime_cost_pct
FROM dept_rates

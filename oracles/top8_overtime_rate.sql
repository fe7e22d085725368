SELECT department, ot_shift_pct AS overtime_rate_pct FROM dept_rates
ORDER BY ot_shift_pct DESC, department LIMIT 8

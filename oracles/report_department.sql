SELECT department, shifts, CAST(h_c AS DOUBLE) / 100 AS total_hours, CAST(o_c AS DOUBLE) / 100 AS total_ot,
       CAST(gp_c AS DOUBLE) / 100 AS total_payroll
FROM dept

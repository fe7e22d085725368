SELECT CAST(sum(gp_c) AS DOUBLE) / 100 AS total_payroll, CAST(sum(h_c) AS DOUBLE) / 100 AS total_hours,
       CAST((2 * sum(o_c) * 1000 + sum(h_c)) // (2 * sum(h_c)) AS DOUBLE) / 10 AS overtime_pct,
       count(*) AS departments,
       (SELECT count(*) FROM validated WHERE error_reason IS NOT NULL) AS error_count
FROM dept

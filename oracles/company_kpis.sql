SELECT CAST(sum(gp_c) AS DOUBLE) / 100 AS total_payroll, CAST(sum(h_c) AS DOUBLE) / 100 AS total_hours,
       CAST(sum(o_c) AS DOUBLE) / 100 AS total_overtime_hours, CAST(sum(op_c) AS DOUBLE) / 100 AS total_overtime_cost,
       CAST((2 * sum(o_c) * 1000 + sum(h_c)) // (2 * sum(h_c)) AS DOUBLE) / 10 AS overtime_rate_pct,
       CAST((2 * sum(op_c) * 1000 + sum(gp_c)) // (2 * sum(gp_c)) AS DOUBLE) / 10 AS overtime_pay_pct,
       (SELECT department FROM dept ORDER BY gp_c DESC, department LIMIT 1) AS costliest_department
FROM dept

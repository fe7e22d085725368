SELECT department, CAST(gp_c AS DOUBLE) / 100 AS total_gross_pay,
       CAST(o_c * avg_rate_c * 15 AS DOUBLE) / 100000 AS overtime_pay_estimate,
       CAST(gp_c * 1000 - o_c * avg_rate_c * 15 AS DOUBLE) / 100000 AS regular_pay_estimate
FROM dept_rates

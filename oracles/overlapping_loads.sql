, by_department AS (
    SELECT employee_id, week_start, department, (sum(h4) + 50) // 100 AS h_c,
           (sum(o4) + 50) // 100 AS o_c, sum(gp_c) AS gp_c, count(log_id) AS shifts
    FROM all_logs WHERE nth_third = 1 GROUP BY ALL
)
SELECT employee_id, week_start, CAST(sum(shifts) AS INT) AS stored_shifts,
       CAST(sum(shifts) AS INT) AS num_shifts, CAST(sum(h_c) AS DOUBLE) / 100 AS total_hours,
       CAST(sum(o_c) AS DOUBLE) / 100 AS total_overtime, CAST(sum(gp_c) AS DOUBLE) / 100 AS total_gross_pay
FROM by_department GROUP BY employee_id, week_start

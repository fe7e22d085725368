, first_half AS (SELECT * FROM arrived_logs WHERE k1 % 2 = 0),
old_rows AS (
    SELECT employee_id, week_start, arg_max(department, (h_c, -dept_no)) AS department,
           sum(h_c) AS h_c, sum(o_c) AS o_c, sum(gp_c) AS gp_c, sum(shifts) AS shifts
    FROM (SELECT *, dense_rank() OVER (ORDER BY department) AS dept_no
          FROM (SELECT employee_id, week_start, department, (sum(h4) + 50) // 100 AS h_c,
                       (sum(o4) + 50) // 100 AS o_c, sum(gp_c) AS gp_c, count(log_id) AS shifts
                FROM first_half GROUP BY ALL))
    GROUP BY employee_id, week_start
), new_rows AS (
    SELECT employee_id, week_start, arg_max(department, (h_c, -dept_no)) AS department,
           sum(h_c) AS h_c, sum(o_c) AS o_c, sum(gp_c) AS gp_c, sum(shifts) AS shifts
    FROM (SELECT *, dense_rank() OVER (ORDER BY department) AS dept_no
          FROM (SELECT employee_id, week_start, department, (sum(h4) + 50) // 100 AS h_c,
                       (sum(o4) + 50) // 100 AS o_c, sum(gp_c) AS gp_c, count(log_id) AS shifts
                FROM arrived_logs GROUP BY ALL))
    GROUP BY employee_id, week_start
)
SELECT employee_id, week_start, coalesce(o.department, n.department) AS department,
       CAST(n.h_c AS DOUBLE) / 100 AS total_hours, CAST(n.o_c AS DOUBLE) / 100 AS total_overtime,
       CAST(n.gp_c AS DOUBLE) / 100 AS total_gross_pay,
       CAST(n.shifts AS INT) AS num_shifts, 'weekly' AS pay_period
FROM new_rows n LEFT JOIN old_rows o USING (employee_id, week_start)

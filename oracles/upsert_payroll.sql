, old_rows AS (
    SELECT employee_id, week_start, arg_max(department, (h_c, -dept_no)) AS department,
           sum(h_c) AS h_c, sum(o_c) AS o_c, sum(gp_c) AS gp_c, sum(shifts) AS shifts
    FROM (SELECT *, dense_rank() OVER (ORDER BY department) AS dept_no
          FROM (SELECT employee_id, week_start, department, (sum(h4) + 50) // 100 AS h_c,
                       (sum(o4) + 50) // 100 AS o_c, sum(gp_c) AS gp_c, count(log_id) AS shifts
                FROM early_logs GROUP BY ALL))
    GROUP BY employee_id, week_start
), new_rows AS (
    SELECT employee_id, week_start, arg_max(department, (h_c, -dept_no)) AS department,
           sum(h_c) AS h_c, sum(o_c) AS o_c, sum(gp_c) AS gp_c, sum(shifts) AS shifts
    FROM (SELECT *, dense_rank() OVER (ORDER BY department) AS dept_no
          FROM (SELECT employee_id, week_start, department, (sum(h4) + 50) // 100 AS h_c,
                       (sum(o4) + 50) // 100 AS o_c, sum(gp_c) AS gp_c, count(log_id) AS shifts
                FROM logs GROUP BY ALL))
    GROUP BY employee_id, week_start
)
SELECT employee_id, week_start, coalesce(o.department, n.department) AS department,
       CAST(coalesce(n.h_c, o.h_c) AS DOUBLE) / 100 AS total_hours,
       CAST(coalesce(n.o_c, o.o_c) AS DOUBLE) / 100 AS total_overtime,
       CAST(coalesce(n.gp_c, o.gp_c) AS DOUBLE) / 100 AS total_gross_pay,
       CAST(coalesce(n.shifts, o.shifts) AS INT) AS num_shifts, 'weekly' AS pay_period
FROM old_rows o FULL JOIN new_rows n USING (employee_id, week_start)

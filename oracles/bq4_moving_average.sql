, weeks AS (
  SELECT log_date - CAST(dayofweek(log_date) AS INT) AS week_start, sum(gp_c) AS gp_c FROM logs GROUP BY 1
),
framed AS (
  SELECT week_start, gp_c,
         sum(gp_c) OVER (ORDER BY week_start ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS n,
         count(*) OVER (ORDER BY week_start ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS d
  FROM weeks
)
SELECT CAST(week_start AS DATE) AS week_start, CAST(gp_c AS DOUBLE) / 100 AS actual_payroll,
       CAST((2 * n + d) // (2 * d) AS DOUBLE) / 100 AS moving_avg_4wk
FROM framed

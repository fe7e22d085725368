SELECT CAST((2 * sum(h4) + 100 * count(*)) // (200 * count(*)) AS DOUBLE) / 100 AS avg_hours,
       CAST((2 * sum(gp_c) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS avg_gross_pay,
       CAST((sum(o4) + 500) // 1000 AS DOUBLE) / 10 AS total_overtime_hours,
       (SELECT count(*) FROM clean WHERE department IS NULL) AS departments_filled
FROM logs

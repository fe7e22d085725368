SELECT CASE WHEN o4 = 0 THEN '0 hrs' WHEN o4 BETWEEN 100 AND 10000 THEN '0-1 hrs'
            WHEN o4 BETWEEN 10000 AND 20000 THEN '1-2 hrs' WHEN o4 BETWEEN 20000 AND 40000 THEN '2-4 hrs'
            WHEN o4 > 40000 THEN '4+ hrs' END AS overtime_bucket,
       count(*) AS shift_count,
       CAST((2 * sum(gp_c) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS avg_gross_pay,
       CAST(sum(op_c) AS DOUBLE) / 100 AS total_overtime_cost
FROM logs GROUP BY 1

SELECT * FROM (
  SELECT e.employee_id, first_name || ' ' || last_name AS full_name, department, pay_rate,
         CAST((h4 + 50) // 100 AS DOUBLE) / 100 AS total_hours, CAST(gp_c AS DOUBLE) / 100 AS total_cost,
         CAST(op_c AS DOUBLE) / 100 AS total_overtime_cost, rank() OVER (ORDER BY gp_c DESC) AS cost_rank
  FROM employees e JOIN person p ON e.employee_id = p.employee_id
) WHERE cost_rank <= 10

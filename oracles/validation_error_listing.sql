, chosen AS (SELECT log_id, employee_id, clock_in, clock_out, department, pay_rate, log_date, error_reason FROM validated WHERE error_reason = 'INVALID_HOURS')
SELECT *, (SELECT count(*) FROM chosen) AS total, least((SELECT count(*) FROM chosen), 100) AS showing
FROM chosen ORDER BY log_id, clock_in, clock_out, employee_id LIMIT 100

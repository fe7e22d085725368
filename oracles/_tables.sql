WITH staff AS (
  SELECT s_suppkey,
         'EMP' || lpad(CAST(s_suppkey AS VARCHAR), greatest(7, length(CAST(s_suppkey AS VARCHAR)))::INT, '0') AS employee_id,
         split_part(s_name, '#', 1) AS first_name,
         split_part(s_name, '#', 2) AS last_name,
         n_name AS department,
         1850 + CAST(round(abs(s_acctbal) * 100) AS BIGINT) % 6651 AS rate_c,
         DATE '2015-01-01' + CAST(s_suppkey * 37 % 3651 AS INT) AS hire_date,
         CASE s_suppkey % 6 WHEN 4 THEN 'Inactive' WHEN 5 THEN 'On Leave' ELSE 'Active' END AS status
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
),
employees AS (
  SELECT *, lower(employee_id) || '@example.org' AS email, CAST(rate_c AS DOUBLE) / 100 AS pay_rate
  FROM staff
),
lines AS (
  SELECT *, (l_orderkey * 7 + l_partkey) % 100 AS kind,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS price_c,
         l_shipdate + to_seconds(
           CASE l_linenumber WHEN 1 THEN 6 WHEN 2 THEN 7 WHEN 3 THEN 8 WHEN 4 THEN 9
                             WHEN 5 THEN 10 WHEN 6 THEN 14 ELSE 22 END * 3600
           + l_partkey % 60 * 60 + l_orderkey % 60) AS clock_in
  FROM lineitem
),
raw_logs AS (
  SELECT 'LOG' || lpad(CAST(l_orderkey * 10 + l_linenumber AS VARCHAR),
                       greatest(9, length(CAST(l_orderkey * 10 + l_linenumber AS VARCHAR)))::INT, '0') AS log_id,
         CASE l_partkey % 101 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE employee_id END AS employee_id,
         clock_in,
         clock_in + to_seconds(
           CASE WHEN kind < 5 THEN NULL WHEN kind <= 6 THEN -(3600 + price_c % 7201)
                WHEN kind = 7 THEN 0 WHEN kind = 8 THEN 600 WHEN kind = 9 THEN 90000
                WHEN kind = 10 THEN 1800 WHEN kind = 11 THEN 86400 WHEN kind = 12 THEN 28800
                WHEN kind = 13 THEN 28801 ELSE 14400 + price_c % 36001 END) AS clock_out,
         CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE department END AS department,
         rate_c, CAST(rate_c AS DOUBLE) / 100 AS pay_rate,
         CAST(l_shipdate AS DATE) AS log_date,
         l_partkey AS k1, l_suppkey AS k2, l_shipdate AS k3, price_c AS k4, l_quantity AS k5
  FROM lines JOIN employees ON l_suppkey = s_suppkey
),
numbered AS (
  SELECT *,
         row_number() OVER (PARTITION BY log_id ORDER BY clock_in, k1, k2, k3, k4, k5) AS nth,
         row_number() OVER (PARTITION BY log_id, k1 % 2 ORDER BY clock_in, k1, k2, k3, k4, k5) AS nth_in_half,
         row_number() OVER (PARTITION BY log_id ORDER BY k1 % 2, clock_in, k1, k2, k3, k4, k5) AS nth_arrival,
         row_number() OVER (PARTITION BY log_id ORDER BY k1 % 3, clock_in, k1, k2, k3, k4, k5) AS nth_third,
         date_diff('second', clock_in, clock_out) AS sec
  FROM raw_logs
),
judged AS (
  SELECT *,
         CASE WHEN employee_id IS NULL OR employee_id = '' THEN 'MISSING_EMPLOYEE_ID'
              WHEN clock_out IS NULL THEN 'MISSING_CLOCK_OUT'
              WHEN clock_out <= clock_in THEN 'INVALID_CLOCK_SEQUENCE'
              WHEN sec < 1800 OR sec > 86400 THEN 'INVALID_HOURS' END AS own_reason
  FROM numbered
),
validated AS (
  SELECT *, CASE WHEN nth > 1 THEN 'DUPLICATE_RECORD' ELSE own_reason END AS error_reason FROM judged
),
clean AS (SELECT * FROM validated WHERE error_reason IS NULL),
timed AS (
  SELECT *, (sec * 50 + 9) // 18 AS h4 FROM judged WHERE own_reason IS NULL
),
paid AS (
  SELECT * REPLACE (coalesce(department, 'UNKNOWN') AS department),
         least(h4, 80000) AS r4, greatest(h4 - 80000, 0) AS o4,
         (least(h4, 80000) * rate_c + 5000) // 10000 AS rp_c,
         (greatest(h4 - 80000, 0) * rate_c * 15 + 50000) // 100000 AS op_c
  FROM timed
),
all_logs AS (
  SELECT *, rp_c + op_c AS gp_c, CAST(date_trunc('week', log_date) AS DATE) AS week_start FROM paid
),
logs AS (SELECT * FROM all_logs WHERE nth = 1),
early_logs AS (SELECT * FROM all_logs WHERE k1 % 2 = 0 AND nth_in_half = 1),
arrived_logs AS (SELECT * FROM all_logs WHERE nth_arrival = 1),
payroll AS (
  SELECT employee_id, week_start, department,
         (sum(h4) + 50) // 100 AS h_c, (sum(o4) + 50) // 100 AS o_c, sum(gp_c) AS gp_c,
         count(log_id) AS shifts
  FROM logs GROUP BY ALL
),
dept AS (
  SELECT department, count(DISTINCT employee_id) AS staff_n, count(log_id) AS shifts,
         count(*) FILTER (WHERE o4 > 0) AS ot_shifts,
         sum(h4) AS h4, sum(o4) AS o4, sum(gp_c) AS gp_c, sum(op_c) AS op_c, sum(rate_c) AS rate_c,
         (sum(h4) + 50) // 100 AS h_c, (sum(o4) + 50) // 100 AS o_c
  FROM logs GROUP BY department
),
dept_rates AS (
  SELECT *, CAST((2 * rate_c + shifts) // (2 * shifts) AS DOUBLE) / 100 AS avg_rate,
         CAST((2 * rate_c + shifts) // (2 * shifts) AS HUGEINT) AS avg_rate_c,
         CAST((2 * gp_c * 100 * 100 + h4) // (2 * h4) AS DOUBLE) / 100 AS eff_rate,
         CAST((2 * ot_shifts * 10000 + shifts) // (2 * shifts) AS DOUBLE) / 100 AS ot_shift_pct,
         CASE WHEN gp_c > 0 THEN CAST((2 * op_c * 10000 + gp_c) // (2 * gp_c) AS DOUBLE) / 100 END AS ot_cost_pct,
         CAST((2 * o4 * 10000 + h4) // (2 * h4) AS DOUBLE) / 100 AS ot_hours_pct,
         CAST((2 * o4 + shifts) // (2 * shifts) AS DOUBLE) / 10000 AS avg_ot
  FROM dept
),
person AS (
  SELECT employee_id, count(log_id) AS shifts, sum(h4) AS h4, sum(o4) AS o4,
         sum(gp_c) AS gp_c, sum(op_c) AS op_c
  FROM logs GROUP BY employee_id
)

, flagged AS (SELECT * FROM validated WHERE error_reason IS NOT NULL)
SELECT 'validation_errors' AS table_name, rule, CAST(violations AS BIGINT) AS violations
FROM (SELECT count(*) FILTER (WHERE error_reason IS NULL) AS error_reason_required,
             0::BIGINT AS flagged_at_required,
             count(*) FILTER (WHERE length(log_id) > 12) AS log_id_length,
             count(*) FILTER (WHERE length(employee_id) > 10) AS employee_id_length,
             count(*) FILTER (WHERE length(department) > 100) AS department_length,
             count(*) FILTER (WHERE length(error_reason) > 100) AS error_reason_length,
             0::BIGINT AS pipeline_run_id_length
      FROM flagged)
UNPIVOT (violations FOR rule IN (error_reason_required, flagged_at_required, log_id_length,
  employee_id_length, department_length, error_reason_length, pipeline_run_id_length))

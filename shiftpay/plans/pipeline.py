"""The batch run: read, validate, compute pay, export, load, upload."""

from __future__ import annotations

import time
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from shiftpay.operators import pay, quality
from shiftpay.plans.load import load_raw
from shiftpay.sources import sinks


def run_pipeline(
    spark: SparkSession,
    root: str,
    employees: DataFrame,
    raw: DataFrame,
    ingest_order: list[str],
    employee_order: list[str],
    csv_export: bool = False,
    warehouse: str | None = None,
) -> DataFrame:
    """Process ``raw`` into the tables below ``root``; a one-row frame of run metrics.

    ``warehouse`` also loads the warehouse tables there. Ids that the tables know from
    earlier loads are passed over. A load that fails stops the run; a failed upload is
    recorded in its step and in the status. Seconds are given for each step.
    """
    started = datetime.now(timezone.utc)
    clock = time.monotonic()
    run_id = started.strftime("%Y%m%d_%H%M%S")
    directory = [c for c in employees.columns if not c.startswith("_")]

    seconds = {}

    def timed(step: str, work):
        begin = time.monotonic()
        found = work()
        seconds[step] = round(time.monotonic() - begin, 2)
        return found

    staff = timed(
        "employees", lambda: sinks.load_employees(root, employees, started, employee_order)
    )
    load = timed(
        "load",
        lambda: load_raw(
            root, raw, ingest_order, None, run_id, started, known_are_errors=False
        ),
    )
    batch_id = load.number

    try:

        def export():
            sinks.write_csv(load.logs, f"{root}/export/time_logs")
            sinks.write_csv(pay.payroll_summary(load.logs), f"{root}/export/payroll_summary")
            sinks.write_csv(employees.select(*directory), f"{root}/export/employees")

        if csv_export:
            timed("export", export)

        upload = sinks.Upload({})
        if warehouse:
            upload = timed(
                "upload",
                lambda: sinks.upload_all(
                    warehouse, load.logs, load.weeks, employees.select(*directory), batch_id, started
                ),
            )

        counts = timed(
            "metrics",
            lambda: quality.run_metrics(load.validated)
            .select(
                F.struct("*").alias("validate"),
                pay.run_totals(load.logs).select(F.struct("*")).scalar().alias("transform"),
            )
            .toArrow(),
        )
    finally:
        load.discard()
    durations = [
        F.lit(seconds.get(s)).cast("double").alias(s)
        for s in ("employees", "load", "export", "upload", "metrics")
    ]
    problem = upload.problem
    return spark.createDataFrame(counts).select(
        F.lit(run_id).alias("run_id"),
        F.lit(started).alias("started_at"),
        F.lit(batch_id).alias("batch_id"),
        "validate",
        "transform",
        F.struct(
            F.lit(staff).alias("employees"),
            F.lit(load.logs_inserted).alias("time_logs"),
            F.lit(load.payroll_rows).alias("payroll_summary"),
        ).alias("load"),
        F.struct(
            F.lit("skipped" if not warehouse else "failed" if problem else "success").alias("status"),
            F.lit(problem).cast("string").alias("error"),
        ).alias("upload"),
        F.struct(*durations).alias("duration_s"),
        F.lit(round(time.monotonic() - clock, 2)).alias("total_duration_s"),
        F.lit("FAILED" if problem else "SUCCESS").alias("status"),
    )

"""Command line: a batch run, incremental loads, uploads, and the daily report."""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from shiftpay.operators import metrics
from shiftpay.plans.pipeline import run_pipeline
from shiftpay.session import build_session
from shiftpay.sources import readers, sinks
from shiftpay.streaming import incremental


def _arguments(given: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="shiftpay", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    run = commands.add_parser("run", help="load raw files into the tables")
    run.add_argument("employees", help="employee CSV: file, folder or glob")
    run.add_argument("time_logs", help="raw shift CSV: file, folder or glob")
    run.add_argument("tables", help="folder of the tables")
    run.add_argument("--csv", action="store_true", help="also export the results as CSV")
    run.add_argument("--warehouse", help="also load the warehouse tables in this folder")

    follow = commands.add_parser("follow", help="load raw shift files not loaded yet")
    follow.add_argument("time_logs", help="folder of raw shift CSV files")
    follow.add_argument("tables", help="folder of the tables")
    follow.add_argument("checkpoint", help="folder that remembers the loaded files")

    upload = commands.add_parser("upload", help="bring a warehouse up to date with the tables")
    upload.add_argument("tables", help="folder of the tables")
    upload.add_argument("warehouse", help="folder of the warehouse tables")

    report = commands.add_parser("report", help="show the daily report")
    report.add_argument("tables", help="folder of the tables")
    return parser.parse_args(given)


def main(given: list[str] | None = None) -> None:
    chosen = _arguments(given)
    spark = build_session()
    if chosen.command == "run":
        order = readers.FILE_ORDER
        run_pipeline(
            spark,
            chosen.tables,
            readers.read_employees(spark, chosen.employees),
            readers.read_time_logs(spark, chosen.time_logs),
            order,
            order,
            csv_export=chosen.csv,
            warehouse=chosen.warehouse,
        ).show(truncate=False, vertical=True)
    elif chosen.command == "follow":
        stream = incremental.raw_file_stream(spark, chosen.time_logs)
        incremental.run_available(stream, chosen.tables, chosen.checkpoint).awaitTermination()
    elif chosen.command == "upload":
        done = sinks.upload_stored(
            spark, chosen.tables, chosen.warehouse, datetime.now(timezone.utc)
        )
        print(done.rows, done.problem or "")
    else:
        logs = sinks.time_logs(spark, chosen.tables)
        metrics.report_totals(logs).show()
        metrics.report_departments(logs).show(truncate=False)


if __name__ == "__main__":
    main()

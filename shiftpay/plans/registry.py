"""Every query by name, over the given tables of a folder."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from datetime import datetime
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shiftpay import schemas
from shiftpay.operators import constraints, listings, merge, metrics, pay, quality, reports
from shiftpay.plans.load import load_raw
from shiftpay.plans.pipeline import run_pipeline
from shiftpay.sources import files, readers, sinks, timeclock
from shiftpay.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]

ORACLES = Path(__file__).resolve().parents[2] / "oracles"
_RUN_ID = "check"
_EARLIER = datetime(2024, 1, 1)
_NOW = datetime(2024, 2, 1)

_QUERIES: dict[str, Query] = {}


class Tables:
    """The frames the queries start from."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self._dir = spark, sf_dir

    def employees(self) -> DataFrame:
        return timeclock.employees(self.spark, self._dir)

    def raw(self) -> DataFrame:
        return timeclock.raw_time_logs(self.spark, self._dir)

    def _validate(self, raw: DataFrame) -> DataFrame:
        return quality.validate(raw, timeclock.INGEST_ORDER)

    def validated(self) -> DataFrame:
        return self._validate(self.raw())

    def early_logs(self) -> DataFrame:
        """What a load of the even part keys alone would store."""
        raw = self.raw().filter("k1 % 2 = 0")
        return pay.transform(quality.clean_logs(self._validate(raw)))

    def clean(self) -> DataFrame:
        return quality.clean_logs(self.validated())

    def errors(self) -> DataFrame:
        return quality.validation_errors(self.validated(), _RUN_ID, _NOW)

    def logs(self) -> DataFrame:
        return pay.transform(self.clean())

    def payroll(self) -> DataFrame:
        return pay.payroll_summary(self.logs())


def _plain(rows: DataFrame) -> DataFrame:
    """Decimals as doubles and zoned times as plain ones, to compare across engines."""
    changed = {
        f.name: F.col(f.name).cast(
            "double" if isinstance(f.dataType, T.DecimalType) else "timestamp_ntz"
        )
        for f in rows.schema.fields
        if isinstance(f.dataType, (T.DecimalType, T.TimestampType))
    }
    return rows.withColumns(changed) if changed else rows


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain(build(Tables(spark, sf_dir)))

    run.__name__ = build.__name__
    _QUERIES[build.__name__] = run
    return build


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    """SQL of each query that has one: the shared tables, then its own statement."""
    base = (ORACLES / "_tables.sql").read_text().strip()
    found = {}
    for name in _QUERIES:
        text = ORACLES / f"{name}.sql"
        if text.exists():
            found[name] = f"{base}\n{text.read_text().strip()}"
    return found


# --- sources and loads ---------------------------------------------------------


@query
def employees(t: Tables) -> DataFrame:
    return t.employees()


@query
def raw_time_logs(t: Tables) -> DataFrame:
    """Raw shifts through text, as a CSV holds them: a missing clock_out is ''."""
    raw = t.raw()
    text = raw.select(
        "log_id",
        "employee_id",
        F.date_format("clock_in", "yyyy-MM-dd HH:mm:ss").alias("clock_in"),
        F.coalesce(F.date_format("clock_out", "yyyy-MM-dd HH:mm:ss"), F.lit("")).alias("clock_out"),
        "department",
        F.col("pay_rate").cast("string").alias("pay_rate"),
        F.col("log_date").cast("string").alias("log_date"),
    )
    return readers.parse(text, schemas.RAW_LOGS)


@query
def employees_csv(t: Tables) -> DataFrame:
    """The directory through a CSV file."""
    path = f"{files.new_folder(t.spark, 'csv')}/employees"
    sinks.write_csv(t.employees(), path)
    return readers.read_employees(t.spark, path).select(*schemas.names(schemas.EMPLOYEES))


@query
def raw_logs_csv(t: Tables) -> DataFrame:
    """Raw shifts through a CSV file."""
    path = f"{files.new_folder(t.spark, 'csv')}/time_logs"
    sinks.write_csv(t.raw().select(*schemas.names(schemas.RAW_LOGS)), path)
    return readers.read_time_logs(t.spark, path).select(*schemas.names(schemas.RAW_LOGS))


@query
def processed_csv(t: Tables) -> DataFrame:
    """Processed shifts as exported and read again, times as text to the second."""
    path = f"{files.new_folder(t.spark, 'csv')}/time_logs"
    sinks.write_csv(t.logs(), path)
    return readers.read_processed(t.spark, path, schemas.TIME_LOGS)


@query
def processed_tables(t: Tables) -> DataFrame:
    """Rows of the processed tables and of the error report as written, by table; a report
    without errors is not written and reads as empty."""
    folder = files.new_folder(t.spark, "processed")
    # the order of arrival has served its end
    judged = t.validated().select(*schemas.names(schemas.RAW_LOGS), "error_reason")
    validated = files.stage(judged, "processed", files.CODEC)
    clean = quality.clean_logs(validated)
    errors = quality.validation_errors(validated, _RUN_ID, _NOW)
    written = {
        "employees": sinks.write_table(t.employees(), f"{folder}/employees"),
        "time_logs": sinks.write_logs(clean, f"{folder}/time_logs", pay.transform),
    }
    # shifts of an employee and week lie together as written, so their sums are few rows
    logs = readers.read_table(t.spark, f"{folder}/time_logs", schemas.TIME_LOGS)
    written["payroll_summary"] = sinks.write_table(pay.payroll_summary(logs), f"{folder}/payroll")
    sinks.write_errors(errors, f"{folder}/errors")
    sinks.write_errors(errors.filter("false"), f"{folder}/no_errors")
    for name in ("errors", "no_errors"):
        found = readers.read_table(t.spark, f"{folder}/{name}", schemas.VALIDATION_ERRORS)
        written[name] = found.count()
    return t.spark.createDataFrame(sorted(written.items()), "table_name string, row_count bigint")


@query
def upload_modes(t: Tables) -> DataFrame:
    """Rows of a warehouse table after each write mode, one after the other."""
    path = f"{files.new_folder(t.spark, 'modes')}/employees"
    staff, counts = t.employees(), []
    active = staff.filter(F.col("status") == reports.ACTIVE)
    for step, (rows, mode) in enumerate(
        [(staff, sinks.EMPTY), (active, sinks.APPEND), (active, sinks.TRUNCATE)]
    ):
        sinks.upload(rows, path, mode)
        counts.append((step, mode, t.spark.read.parquet(path).count()))
    return t.spark.createDataFrame(counts, "step bigint, mode string, row_count bigint")


@query
def warehouse_tables(t: Tables) -> DataFrame:
    """Shifts of the warehouse after two runs, each with its table's rows added."""
    raw = t.raw()
    _, warehouse = _two_runs(t, raw.filter("k1 % 2 = 0"), raw)
    staff = t.spark.read.parquet(f"{warehouse}/employees")
    parts = [
        sinks.time_logs(t.spark, warehouse).select(F.lit("time_logs").alias("table_name"), "employee_id"),
        sinks.payroll(t.spark, warehouse).select(F.lit("payroll_summary"), "employee_id"),
        staff.select(F.lit("employees"), "employee_id"),
    ]
    rows = reduce(DataFrame.union, parts)
    return rows.groupBy("table_name", "employee_id").agg(F.count("*").alias("row_count"))


def _earlier_employees(staff: DataFrame) -> DataFrame:
    even = F.substring("employee_id", -1, 1).cast("int") % 2 == 0
    return staff.filter(even).select(
        "employee_id",
        "first_name",
        "last_name",
        "department",
        (F.col("pay_rate") - F.lit(1)).cast("decimal(8,2)").alias("pay_rate"),
        "hire_date",
        "status",
        "email",
        F.lit(_EARLIER).cast("timestamp").alias("created_at"),
        F.lit(_EARLIER).cast("timestamp").alias("updated_at"),
    )


@query
def upsert_employees(t: Tables) -> DataFrame:
    staff = t.employees()
    return merge.upsert_employees(_earlier_employees(staff), staff, _NOW)


@query
def insert_new_logs(t: Tables) -> DataFrame:
    """Shifts the whole load adds to a table filled from the even part keys."""
    return merge.absent_logs(t.early_logs(), t.logs())


@query
def upsert_payroll(t: Tables) -> DataFrame:
    old = pay.fold_payroll(pay.payroll_summary(t.early_logs()))
    return merge.upsert_payroll(old, pay.fold_payroll(t.payroll()))


@query
def incremental_payroll(t: Tables) -> DataFrame:
    """Payroll table after two loads through the stream: even part keys, then odd."""
    spark = t.spark
    folder = files.new_folder(spark, "incremental")
    raw = t.raw()
    for half in (0, 1):
        raw.filter(F.col("k1") % 2 == half).write.mode("append").parquet(f"{folder}/raw")
        stream = incremental.table_stream(spark, f"{folder}/raw", raw.schema)
        incremental.run_available(
            stream, f"{folder}/tables", f"{folder}/progress", timeclock.INGEST_ORDER
        ).awaitTermination()
    return sinks.payroll(spark, f"{folder}/tables").drop("created_at")


@query
def mixed_loads(t: Tables) -> DataFrame:
    """Stored shifts after a batch run, two loads of a stream, and a new stream that plays
    all files of the first one again."""
    spark, raw = t.spark, t.raw()
    folder = files.new_folder(spark, "mixed")
    tables = f"{folder}/tables"

    def follow(progress: str) -> None:
        stream = incremental.table_stream(spark, f"{folder}/raw", raw.schema)
        incremental.run_available(
            stream, tables, f"{folder}/{progress}", timeclock.INGEST_ORDER
        ).awaitTermination()

    load_raw(
        tables, raw.filter("k1 % 3 = 0"), timeclock.INGEST_ORDER, None, "run", _NOW,
        known_are_errors=False,
    ).discard()
    for part in (1, 2):
        raw.filter(F.col("k1") % 3 == part).write.mode("append").parquet(f"{folder}/raw")
        follow("progress")
    follow("again")
    return sinks.time_logs(spark, tables).select(*schemas.names(schemas.TIME_LOGS))


class _Lost(Exception):
    """A load that breaks off."""


@query
def overlapping_loads(t: Tables) -> DataFrame:
    """Stored shifts and payroll, by employee and week, after loads that overlap.

    The second load begins before the first one does and commits after it. The third breaks
    off when all of it is written, and is repeated.
    """
    spark, raw = t.spark, t.raw()
    tables = f"{files.new_folder(spark, 'overlapping')}/tables"

    def load(part: int, before_commit=None) -> None:
        load_raw(
            tables, raw.filter(F.col("k1") % 3 == part), timeclock.INGEST_ORDER, None, f"run {part}",
            _NOW, before_commit=before_commit,
        ).discard()

    def lose() -> None:
        raise _Lost

    meanwhile = iter([lambda: load(0)])
    load(1, lambda: next(meanwhile, lambda: None)())
    with suppress(_Lost):
        load(2, lose)
    load(2)
    stored = pay.fold_payroll(pay.payroll_summary(sinks.time_logs(spark, tables)))
    shown = ["employee_id", "week_start"]
    return (
        sinks.payroll(spark, tables)
        .join(stored.select(*shown, F.col("num_shifts").alias("stored_shifts")), shown, "full")
        .select(*shown, "stored_shifts", "num_shifts", "total_hours", "total_overtime", "total_gross_pay")
    )


def _two_runs(t: Tables, first: DataFrame, second: DataFrame) -> tuple[str, str]:
    """Folders of the tables and of the warehouse after two batch runs."""
    folder = files.new_folder(t.spark, "runs")
    tables, warehouse = f"{folder}/tables", f"{folder}/warehouse"
    for raw in (first, second):
        run_pipeline(
            t.spark, tables, t.employees(), raw, timeclock.INGEST_ORDER, ["employee_id"],
            warehouse=warehouse,
        )
    return tables, warehouse


@query
def warehouse_payroll(t: Tables) -> DataFrame:
    """Payroll of the warehouse after two runs, the later shifts of many weeks second."""
    raw = t.raw()
    _, warehouse = _two_runs(t, raw.filter("k1 % 2 = 0"), raw.filter("k1 % 2 = 1"))
    return sinks.payroll(t.spark, warehouse).drop("created_at")


@query
def rerun_errors(t: Tables) -> DataFrame:
    """Stored errors by run and reason after two runs over a folder that grew."""
    raw = t.raw()
    tables, _ = _two_runs(t, raw.filter("k1 % 2 = 0"), raw)
    return (
        sinks.validation_errors(t.spark, tables)
        .groupBy("batch_id", "error_reason")
        .agg(F.count("*").alias("errors"))
    )


# --- quality -------------------------------------------------------------------


def _rule(name: str, reason: str) -> None:
    def build(t: Tables) -> DataFrame:
        columns = schemas.names(schemas.RAW_LOGS)
        return quality.flagged(t.validated(), reason).select(*columns, "error_reason")

    build.__name__ = name
    query(build)


_rule("val_duplicates", quality.DUPLICATE)
_rule("val_missing_employee", quality.NO_EMPLOYEE)
_rule("val_missing_clock_out", quality.NO_CLOCK_OUT)
_rule("val_clock_sequence", quality.BAD_SEQUENCE)
_rule("val_hours", quality.BAD_HOURS)


@query
def validated_logs(t: Tables) -> DataFrame:
    return t.validated().select(
        *schemas.names(schemas.RAW_LOGS), "error_reason"
    )


@query
def val_missing_clock_in(t: Tables) -> DataFrame:
    """Shifts flagged for a missing clock_in, where every ninth one lacks it."""
    raw = t.raw()
    clock_in = F.when(F.col("k1") % 9 != 0, F.col("clock_in"))
    order = [c for c in timeclock.INGEST_ORDER if c != "clock_in"]
    validated = quality.validate(raw.withColumn("clock_in", clock_in), [*order, "clock_out"])
    return quality.flagged(validated, quality.NO_CLOCK_IN).select("log_id", "employee_id", "error_reason")


@query
def skewed_validation(t: Tables) -> DataFrame:
    """Validation with a third of all shifts under one id, and many without any."""
    id_ = F.when(F.col("k1") % 3 == 0, "LOG000000000").when(F.col("k1") % 7 != 1, F.col("log_id"))
    return quality.validate(t.raw().withColumn("log_id", id_), timeclock.INGEST_ORDER).select(
        *schemas.names(schemas.RAW_LOGS), "error_reason"
    )


@query
def clean_logs(t: Tables) -> DataFrame:
    return t.clean()


@query
def validation_errors(t: Tables) -> DataFrame:
    return t.errors()


@query
def run_validation_metrics(t: Tables) -> DataFrame:
    return quality.run_metrics(t.validated())


@query
def validation_error_listing(t: Tables) -> DataFrame:
    return quality.error_listing(
        t.errors(), "invalid_hours", 100, ["clock_in", "clock_out", "employee_id"]
    ).drop("flagged_at", "pipeline_run_id")


@query
def validation_summary(t: Tables) -> DataFrame:
    return quality.error_summary(t.errors())


@query
def constraint_audit(t: Tables) -> DataFrame:
    # each table is audited rule by rule, so its rows are worked out once beforehand
    validated = files.stage(t.validated(), "audit")
    logs = files.stage(pay.transform(quality.clean_logs(validated)), "audit")
    parts = [
        constraints.audit(t.employees(), "employees", constraints.EMPLOYEES),
        constraints.audit(validated, "raw_time_logs", constraints.RAW_LOGS),
        constraints.audit(logs, "time_logs", constraints.TIME_LOGS),
        constraints.audit(pay.payroll_summary(logs), "payroll_summary", constraints.PAYROLL),
    ]
    return constraints.violated(reduce(DataFrame.unionByName, parts))


@query
def error_table_audit(t: Tables) -> DataFrame:
    """Every rule of the errors table, broken or not."""
    return constraints.audit(t.errors(), "validation_errors", constraints.VALIDATION_ERRORS)


@query
def orphan_payroll(t: Tables) -> DataFrame:
    """Payroll rows whose employee is missing from a directory of active employees only."""
    active = t.employees().filter(F.col("status") == reports.ACTIVE)
    return constraints.orphans(t.payroll(), active).select("employee_id", "week_start", "department")


@query
def orphan_time_logs(t: Tables) -> DataFrame:
    """Shifts whose employee is missing from a directory of active employees only."""
    active = t.employees().filter(F.col("status") == reports.ACTIVE)
    return constraints.orphans(t.logs(), active).select("log_id", "employee_id", "clock_in")


# --- pay -----------------------------------------------------------------------


@query
def transformed_logs(t: Tables) -> DataFrame:
    return t.logs()


@query
def transform_stats(t: Tables) -> DataFrame:
    return pay.transform_stats(t.clean())


@query
def payroll_summary(t: Tables) -> DataFrame:
    return t.payroll()


@query
def run_totals(t: Tables) -> DataFrame:
    return pay.run_totals(t.logs())


# --- reports -------------------------------------------------------------------


@query
def q1_hours_per_employee(t: Tables) -> DataFrame:
    return reports.hours_per_employee(t.logs(), t.employees())


@query
def q2_overtime_by_department(t: Tables) -> DataFrame:
    return reports.overtime_by_department(t.logs())


@query
def q3_cost_by_month(t: Tables) -> DataFrame:
    return reports.cost_by_month(t.logs())


@query
def q4_rank_by_hours(t: Tables) -> DataFrame:
    return reports.rank_by_hours(t.logs(), t.employees())


@query
def q5_running_payroll(t: Tables) -> DataFrame:
    return reports.running_payroll(t.logs())


@query
def q6_overtime_pct(t: Tables) -> DataFrame:
    return reports.overtime_pct(t.logs())


@query
def q7_top10_costliest(t: Tables) -> DataFrame:
    return reports.costliest_employees(t.logs(), t.employees())


@query
def q8_attendance_streak(t: Tables) -> DataFrame:
    return reports.attendance_streaks(t.logs())


@query
def bq1_dept_month_cumulative(t: Tables) -> DataFrame:
    return reports.department_month_running(t.logs())


@query
def bq2_overtime_histogram(t: Tables) -> DataFrame:
    return reports.overtime_histogram(t.logs())


@query
def bq3_top_departments(t: Tables) -> DataFrame:
    return reports.top_departments(t.logs())


@query
def bq4_moving_average(t: Tables) -> DataFrame:
    return reports.moving_average(t.logs())


# --- listings ------------------------------------------------------------------


@query
def api_employees_page(t: Tables) -> DataFrame:
    return listings.employees_page(t.employees(), 2, 5, "nation_1", "Active")


@query
def api_employees_middle_page(t: Tables) -> DataFrame:
    return listings.employees_page(t.employees(), 6, 10)


@query
def api_employee_detail(t: Tables) -> DataFrame:
    return listings.employee_profiles(t.logs(), t.employees(), "EMP0000001")


@query
def employee_profiles(t: Tables) -> DataFrame:
    return metrics.long_hours_flag(listings.employee_profiles(t.logs(), t.employees()))


def _payroll_by_week(t: Tables) -> DataFrame:
    """Payroll written once, as the stored table lies: whole weeks in order."""
    rows = t.payroll().hint("rebalance", "week_start").sortWithinPartitions("week_start")
    return files.stage(rows, "payroll")


@query
def api_payroll_page(t: Tables) -> DataFrame:
    return listings.payroll_page_by_week(_payroll_by_week(t), t.employees(), 1, 50, "nation_1")


@query
def api_payroll_last_page(t: Tables) -> DataFrame:
    payroll = _payroll_by_week(t)
    last = max(1, -(-payroll.count() // 500))
    return listings.payroll_page_by_week(payroll, t.employees(), last, 500)


@query
def api_department_summary(t: Tables) -> DataFrame:
    return reports.department_summary(t.logs())


@query
def api_weekly_trend(t: Tables) -> DataFrame:
    return reports.weekly_trend(t.logs(), 12)


@query
def api_overtime_report(t: Tables) -> DataFrame:
    return reports.overtime_report(t.logs())


@query
def api_top_overtime(t: Tables) -> DataFrame:
    return listings.top_overtime(t.logs(), t.employees(), 25)


@query
def api_top_overtime_dept(t: Tables) -> DataFrame:
    return listings.top_overtime(t.logs(), t.employees(), 25, "nation_1")


# --- derived figures -------------------------------------------------------------


@query
def dept_overtime_flags(t: Tables) -> DataFrame:
    return metrics.department_flags(reports.department_summary(t.logs()))


@query
def high_overtime_departments(t: Tables) -> DataFrame:
    return metrics.high_overtime_departments(reports.department_summary(t.logs()))


@query
def overtime_severity(t: Tables) -> DataFrame:
    return metrics.overtime_severity(reports.overtime_report(t.logs()))


@query
def company_kpis(t: Tables) -> DataFrame:
    return metrics.company_kpis(reports.department_overview(t.logs()))


@query
def dashboard_kpis(t: Tables) -> DataFrame:
    validated = t.validated()
    logs = pay.transform(quality.clean_logs(validated))
    return metrics.dashboard_kpis(
        reports.department_summary(logs), quality.flagged(validated)
    )


@query
def dashboard_top_employees(t: Tables) -> DataFrame:
    return listings.badged_top_overtime(t.logs(), t.employees(), 10)


@query
def dept_pay_split_estimate(t: Tables) -> DataFrame:
    return metrics.pay_split_estimate(reports.department_summary(t.logs()))


@query
def top8_overtime_rate(t: Tables) -> DataFrame:
    return metrics.top_overtime_rate(reports.overtime_report(t.logs()))


@query
def report_department(t: Tables) -> DataFrame:
    return metrics.report_departments(t.logs())


@query
def report_totals(t: Tables) -> DataFrame:
    return metrics.report_totals(t.logs())

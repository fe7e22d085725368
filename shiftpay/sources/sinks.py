"""Writers and idempotent loads of the stored tables.

Layout below a warehouse folder, where an attempt is one try to write something:

    commits/K.json                                  which of the folders below count
    employees/attempt=A                             whole directory
    time_logs/batch_id=N/attempt=A/log_month=...    rows inserted by load N
    validation_errors/batch_id=N/attempt=A          rows flagged by load N
    log_ids/attempt=A/bucket=...                    ids that a load met, clean or flagged
    payroll_summary/attempt=A                       one row per employee and week, with the
                                                    exact sums that it was rounded from

Readers see what the last commit names, so a load shows with all its shifts, errors and
payroll weeks or not at all. Loads may overlap and may break off: one that finds another
commit in its way goes on from there, see ``commits`` and ``plans.load``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import date, datetime
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shiftpay import schemas
from shiftpay.operators import merge
from shiftpay.sources import commits, files
from shiftpay.sources.commits import State

_LOG_TABLE = schemas.with_fields(
    schemas.TIME_LOGS, batch_id=T.LongType(), log_month=T.StringType()
)
_ERROR_TABLE = schemas.with_fields(schemas.VALIDATION_ERRORS, batch_id=T.LongType())

APPEND, TRUNCATE, EMPTY = "WRITE_APPEND", "WRITE_TRUNCATE", "WRITE_EMPTY"


def with_month(logs: DataFrame) -> DataFrame:
    return logs.withColumn("log_month", F.date_format("log_date", "yyyy-MM"))


def _stored_rows(spark: SparkSession, path: str) -> int:
    """Rows of a written table, from its file footers."""
    if not files.exists(spark, path):
        return 0
    return spark.read.schema("_none int").parquet(path).count()


def write_logs(
    logs: DataFrame,
    path: str,
    finish: Callable[[DataFrame], DataFrame] | None = None,
    by_month: bool = False,
) -> int:
    """Processed shifts as Parquet by month; rows written.

    The rebalance gives a month as many files as its size asks for, also when one
    month holds most rows; sorted files let readers skip by employee. ``finish`` makes processed
    shifts from the rows after that, so what it adds is not shuffled. Rows that are read from
    such files, ``by_month``, stay in the tasks that read them.
    """
    dealt = with_month(logs)
    if not by_month:
        dealt = dealt.hint("rebalance", "log_month")
    if finish:
        dealt = with_month(finish(dealt))
    (
        dealt.sortWithinPartitions("log_month", "employee_id")
        .write.mode("overwrite")
        .partitionBy("log_month")
        .parquet(path, compression=files.CODEC)
    )
    return _stored_rows(logs.sparkSession, path)


def write_table(rows: DataFrame, path: str, mode: str = "overwrite") -> int:
    """A table as Parquet; rows written."""
    spark = rows.sparkSession
    before = _stored_rows(spark, path) if mode == "append" else 0
    rows.write.mode(mode).parquet(path, compression=files.CODEC)
    return _stored_rows(spark, path) - before


def write_csv(rows: DataFrame, path: str) -> None:
    """Processed table as CSV, times to the second and null as an empty field."""
    text = [
        F.date_format(f.name, "yyyy-MM-dd HH:mm:ss").alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
        else F.col(f.name)
        for f in rows.schema.fields
    ]
    rows.select(*text).write.mode("overwrite").option("header", True).option(
        "emptyValue", ""
    ).csv(path)


def write_errors(errors: DataFrame, path: str) -> bool:
    """Flagged rows; nothing is written when there are none and nothing to replace."""
    if errors.isEmpty() and not files.exists(errors.sparkSession, path):
        return False
    errors.write.mode("overwrite").parquet(path, compression=files.CODEC)
    return True


# --- stored tables -----------------------------------------------------------

#: Folders that the ids of a load are dealt to, so that a small load reads few of them.
ID_BUCKETS = 32
_ID_TABLE = T.StructType().add("log_id", T.StringType()).add("bucket", T.IntegerType())
#: Name of the week of shifts without a date.
_NO_WEEK = "none"
#: Months or buckets of a load by which a table is pruned, at most.
MOST_VALUES = 1000


def new_attempt() -> str:
    return f"a{uuid.uuid4().hex}"


def _read(
    spark: SparkSession, root: str, table: str, schema: T.StructType, folders: list[str]
) -> DataFrame:
    """Rows of the named folders of a table."""
    if not folders:
        return spark.createDataFrame([], schema)
    base = f"{root}/{table}"
    rows = spark.read.schema(schema).option("basePath", base)
    return rows.parquet(*[f"{base}/{f}" for f in folders]).select(*schema.names)


def load_folder(number: int, attempt: str) -> str:
    return f"batch_id={number}/attempt={attempt}"


def _by_load(named: dict[int, str]) -> list[str]:
    return [load_folder(n, a) for n, a in named.items()]


def employees(spark: SparkSession, root: str) -> DataFrame:
    return _employees(spark, root, commits.latest(spark, root))


def _employees(spark: SparkSession, root: str, state: State) -> DataFrame:
    folders = [f"attempt={state.employees}"] if state.employees else []
    return _read(spark, root, "employees", schemas.EMPLOYEE_TABLE, folders)


def time_logs(spark: SparkSession, root: str, state: State | None = None) -> DataFrame:
    state = state or commits.latest(spark, root)
    return _read(spark, root, "time_logs", _LOG_TABLE, _by_load(state.logs))


def loaded_logs(spark: SparkSession, root: str, number: int, attempt: str) -> DataFrame:
    """The processed shifts that an attempt wrote to make load ``number``."""
    rows = _read(spark, root, "time_logs", _LOG_TABLE, [load_folder(number, attempt)])
    return rows.select(*schemas.names(schemas.TIME_LOGS))


def validation_errors(spark: SparkSession, root: str) -> DataFrame:
    errors = commits.latest(spark, root).errors
    return _read(spark, root, "validation_errors", _ERROR_TABLE, _by_load(errors))


def payroll(
    spark: SparkSession,
    root: str,
    state: State | None = None,
    weeks: set[str] | None = None,
    with_parts: bool = False,
) -> DataFrame:
    """Payroll, of all weeks or of those named."""
    state = state or commits.latest(spark, root)
    held: dict[str, list[str]] = {}
    for week, attempt in state.weeks.items():
        if weeks is None or week in weeks:
            held.setdefault(attempt, []).append(week)
    # which weeks of an attempt count is a filter that skips files and row groups
    columns = schemas.PAYROLL_FILE if with_parts else schemas.PAYROLL_TABLE
    schema = schemas.with_fields(columns, attempt=T.StringType())
    rows = _read(spark, root, "payroll_summary", schema, [f"attempt={a}" for a in held])
    counts = [(F.col("attempt") == a) & _in_weeks(some) for a, some in held.items()]
    return rows.filter(reduce(Column.__or__, counts, F.lit(False))).drop("attempt")


def _in_weeks(weeks: list[str]) -> Column:
    known = F.col("week_start").isin(*[date.fromisoformat(w) for w in weeks if w != _NO_WEEK])
    return known | F.col("week_start").isNull() if _NO_WEEK in weeks else known


def id_bucket(column: str = "log_id") -> Column:
    return F.pmod(F.xxhash64(column), F.lit(ID_BUCKETS)).cast("int")


def stored_ids(spark: SparkSession, root: str, attempts: list[str], like: DataFrame) -> DataFrame:
    """(log_id) that these attempts met, from the buckets that ``like`` (log_id) has ids in.

    The list of buckets has ID_BUCKETS entries at most.
    """
    ids = _read(spark, root, "log_ids", _ID_TABLE, [f"attempt={a}" for a in attempts])
    return ids.filter(any_of(like.select(id_bucket().alias("bucket")), "bucket")).select("log_id")


# --- loads -------------------------------------------------------------------


def load_employees(
    root: str, source: DataFrame, now: datetime, order_by: list[str] | None = None
) -> int:
    """Merge ``source`` into the directory; employees added or updated."""
    spark = source.sparkSession
    while True:
        base, attempt = commits.latest(spark, root), new_attempt()
        merged = merge.upsert_employees(_employees(spark, root, base), source, now, order_by)
        path = f"{root}/employees/attempt={attempt}"
        write_table(merged, path)
        if commits.commit(
            spark, root, base,
            lambda state, a=attempt: replace(state, employees=a),
            lambda state, b=base: state.employees == b.employees,
        ):
            touched = F.col("updated_at") == F.lit(now).cast("timestamp")
            return spark.read.parquet(path).filter(touched).count()
        files.remove(spark, path)


def load_time_logs(
    root: str,
    logs: DataFrame,
    batch_id: int,
    order_by: list[str] | None = None,
    by_month: bool = False,
) -> int:
    """Insert shifts whose log_id no earlier load inserted; rows really inserted.

    The rows replace those of an earlier load ``batch_id``. Payroll is left as it is, so
    loads that follow add up their weeks from stored shifts. ``by_month`` says that the shifts
    are read from files that hold them by month.
    """
    spark = logs.sparkSession
    while True:
        base, attempt = commits.latest(spark, root), new_attempt()
        absent = merge.first_logs(logs, order_by)
        in_place = by_month and not order_by
        stored = time_logs(spark, root, base).filter(F.col("batch_id") < batch_id)
        folder = files.new_folder(spark, "known")
        path = f"{root}/time_logs/{load_folder(batch_id, attempt)}"
        try:
            # mostly no id is known; then the shifts are not moved to find that out
            if any(number < batch_id for number in base.logs):
                known = files.stage_in(merge.known_ids(stored, logs), folder, files.CODEC)
                if not known.isEmpty():
                    absent, in_place = merge.without_ids(absent, known), False
            absent = absent.select(*schemas.names(schemas.TIME_LOGS))
            rows = write_logs(absent, path, by_month=in_place)
        finally:
            files.remove(spark, folder)
        if commits.commit(
            spark, root, base,
            lambda state, a=attempt, n=rows: replace(
                state, logs=_with_load(state.logs, batch_id, a, n), loose=state.revision + 1
            ),
            lambda state, b=base: state.logs == b.logs,
        ):
            return rows
        files.remove(spark, path)


def _with_load(named: dict[int, str], number: int, attempt: str, rows: int) -> dict[int, str]:
    """``named`` with the attempt of a load; one without rows has no folder to read."""
    rest = {n: a for n, a in named.items() if n != number}
    return rest | ({number: attempt} if rows else {})


def load_errors(root: str, errors: DataFrame, batch_id: int, attempt: str) -> bool:
    """Write the rows flagged by an attempt to make load ``batch_id``."""
    return write_errors(errors, f"{root}/validation_errors/{load_folder(batch_id, attempt)}")


def write_ids(root: str, rows: DataFrame, attempt: str) -> None:
    """Write the ids of a load by bucket."""
    ids = rows.select("log_id", id_bucket().alias("bucket"))
    path = f"{root}/log_ids/attempt={attempt}"
    ids.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(path, compression=files.CODEC)


def next_batch(spark: SparkSession, root: str) -> int:
    """Number that the next load gets: one above the highest committed one."""
    return commits.latest(spark, root).next_load


def was_loaded(spark: SparkSession, root: str, stream: str, part: int) -> bool:
    """Whether this micro-batch of this stream is a committed load already."""
    loads = commits.latest(spark, root).loads.values()
    return any(x["stream"] == stream and x["part"] == part for x in loads)


def run_errors(spark: SparkSession, root: str, batch_id: int | None = None) -> DataFrame:
    """Rows flagged by one load, the last committed one by default."""
    wanted = next_batch(spark, root) - 1 if batch_id is None else batch_id
    return validation_errors(spark, root).filter(F.col("batch_id") == wanted)


def write_payroll(root: str, merged: DataFrame, attempt: str, by_week: bool = True) -> int:
    """Write whole payroll weeks, ``merged`` of stored and loaded rows; how many were ``loaded``.

    They go to few files, each of some weeks in order, whatever the number of weeks; rows of
    these weeks in older files no longer count. Rows that don't lie in ranges of weeks yet
    (``by_week`` off) are dealt to them.
    """
    path = f"{root}/payroll_summary/attempt={attempt}"
    rows = merged.select(*schemas.names(schemas.PAYROLL_FILE), "loaded")
    if not by_week:
        rows = rows.hint("rebalance", "week_start")
    (
        rows.sortWithinPartitions("week_start", "employee_id")
        .write.parquet(path, compression=files.CODEC)
    )
    return loaded_payroll(merged.sparkSession, root, attempt).count()


def loaded_payroll(spark: SparkSession, root: str, attempt: str) -> DataFrame:
    """The payroll rows that an attempt inserted or updated, as it left them."""
    schema = schemas.with_fields(schemas.PAYROLL_FILE, loaded=T.BooleanType())
    rows = _read(spark, root, "payroll_summary", schema, [f"attempt={attempt}"])
    return rows.filter("loaded").drop("loaded")


def week_names(rows: DataFrame) -> set[str]:
    """The weeks in ``rows`` as a state names them, as many as the calendar has."""
    return {str(r[0] or _NO_WEEK) for r in rows.select("week_start").distinct().collect()}


def with_weeks(state: State, weeks: set[str], attempt: str) -> State:
    return replace(state, weeks=state.weeks | dict.fromkeys(weeks, attempt))


def same_weeks(a: State, b: State, weeks: set[str]) -> bool:
    return all(a.weeks.get(w) == b.weeks.get(w) for w in weeks)


def load_payroll(root: str, summary: DataFrame, now: datetime) -> int:
    """Upsert payroll rows; rows inserted or updated.

    The merged weeks go to folders of their own, and count from the commit on. The rows come
    without shifts, so loads that follow add up their weeks from stored shifts.

    Only weeks in ``summary`` are read. The driver keeps their names, as many as the calendar has.
    """
    spark = summary.sparkSession
    weeks = week_names(summary)
    if not weeks:
        return 0
    while True:
        base, attempt = commits.latest(spark, root), new_attempt()
        stored = payroll(spark, root, base, weeks, with_parts=True)
        merged = merge.fold_into_payroll(stored, summary, now)
        rows = write_payroll(root, merged, attempt)
        if commits.commit(
            spark, root, base,
            lambda state, w=weeks, a=attempt: replace(
                with_weeks(state, w, a), loose=state.revision + 1
            ),
            lambda state, b=base, w=weeks: same_weeks(state, b, w),
        ):
            return rows
        files.remove(spark, f"{root}/payroll_summary/attempt={attempt}")


def _few(rows: DataFrame, column: str) -> list | None:
    """The values of ``column``; None if there are more than MOST_VALUES."""
    values = rows.select(column).distinct().limit(MOST_VALUES + 1).collect()
    return [row[0] for row in values] if len(values) <= MOST_VALUES else None


def any_of(rows: DataFrame, column: str) -> Column:
    """Condition on the values of ``column`` in ``rows``, for partition pruning.

    The list is as long as the load has months or buckets, whatever its row count; where
    wrong dates make it longer than MOST_VALUES, everything passes and joins decide.
    """
    values = _few(rows, column)
    if values is None:
        return F.lit(True)
    known = F.col(column).isin([v for v in values if v is not None])
    return known | F.col(column).isNull() if None in values else known


# --- warehouse loads ---------------------------------------------------------


def without_zone(rows: DataFrame) -> DataFrame:
    """Zoned timestamps as plain ones in the session zone (UTC)."""
    zoned = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


def upload(rows: DataFrame, path: str, mode: str = APPEND) -> int:
    """Load a table of the warehouse by write mode; rows written.

    WRITE_EMPTY refuses a target that has rows. WRITE_TRUNCATE writes the new table beside
    the old one, which stays readable and whole until it is replaced, and for good if the
    write fails.
    """
    spark = rows.sparkSession
    if mode not in (APPEND, TRUNCATE, EMPTY):
        raise ValueError(f"unknown write mode {mode!r}")
    if mode == EMPTY and files.exists(spark, path):
        if not spark.read.parquet(path).isEmpty():
            raise ValueError(f"{path} is not empty")
    files.recover(spark, path)
    if mode != TRUNCATE:
        return write_table(without_zone(rows), path, "append")
    head, _, name = path.rstrip("/").rpartition("/")
    beside = f"{head}/_new_{name}_{uuid.uuid4().hex}"
    try:
        written = write_table(without_zone(rows), beside)
        files.put_in_place(spark, beside, path)
    finally:
        files.remove(spark, beside)
    return written


@dataclass(frozen=True)
class Upload:
    """Rows written to each warehouse table, and what stopped the rest, if anything did."""

    rows: dict[str, int]
    problem: str | None = None


def _upload(root: str, steps: list[tuple[str, Callable[[str], int]]]) -> Upload:
    """Writes in order; the first that fails ends the upload.

    Errors of Spark and of the storage are reported; others are errors of the program.
    """
    written: dict[str, int] = {}
    for table, write in steps:
        try:
            written[table] = written.get(table, 0) + write(root)
        except (PySparkException, Py4JJavaError, OSError) as problem:
            return Upload(written, f"{table}: {problem}")
    return Upload(written)


def _upload_directory(directory: DataFrame) -> tuple[str, Callable[[str], int]]:
    return "employees", lambda path: upload(directory, f"{path}/employees", TRUNCATE)


# The tables go up in the order of their references: shifts and payroll name employees, and
# payroll adds up shifts. So an upload that stops half-way leaves no row whose employee or
# shifts the warehouse doesn't have.


def upload_all(
    root: str,
    logs: DataFrame,
    payroll_weeks: DataFrame,
    directory: DataFrame,
    batch_id: int,
    now: datetime,
) -> Upload:
    """Bring the warehouse tables up to date after load ``batch_id``.

    ``logs`` is read from the stored shifts, by month. ``payroll_weeks`` holds whole weeks: totals over all stored shifts of every employee
    and week that the load touched, since they replace what the warehouse has. Shifts and
    payroll go through the idempotent loads, so loading the same rows again adds none.
    """
    return _upload(
        root,
        [
            _upload_directory(directory),
            ("time_logs", lambda path: load_time_logs(path, logs, batch_id, by_month=True)),
            ("payroll_summary", lambda path: load_payroll(path, payroll_weeks, now)),
        ],
    )


def upload_stored(spark: SparkSession, tables: str, root: str, now: datetime) -> Upload:
    """Bring the warehouse up to date with the stored tables, load by load.

    Each load's shifts go under its own number there, so this may follow or precede
    uploads of single loads.
    """
    state = commits.latest(spark, tables)
    columns, names = schemas.names(schemas.TIME_LOGS), schemas.names(schemas.EMPLOYEES)
    steps = [_upload_directory(_employees(spark, tables, state).select(*names))]
    for number in sorted(state.logs):
        logs = time_logs(spark, tables, state).filter(F.col("batch_id") == number).select(*columns)
        steps.append(
            ("time_logs", lambda path, logs=logs, n=number: load_time_logs(path, logs, n, by_month=True))
        )
    weeks = payroll(spark, tables, state).drop("created_at")
    return _upload(root, [*steps, ("payroll_summary", lambda path: load_payroll(path, weeks, now))])

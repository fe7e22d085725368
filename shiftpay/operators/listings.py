"""Parameterised listings: pages, single profiles and top lists."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from shiftpay import schemas
from shiftpay.functions.columns import full_name, half_up, total
from shiftpay.functions.ranking import with_position

# A profile is the directory row, and when it was created if the directory knows.
PROFILE = [*schemas.names(schemas.EMPLOYEES), "created_at"]


def _profile(employees: DataFrame) -> list[str]:
    """The profile columns a directory has; only stored ones know ``created_at``."""
    return [c for c in PROFILE if c in employees.columns]


def _contains(column: str, text: str) -> Column:
    """Case-blind containment; ``%`` and ``_`` in ``text`` act as wildcards."""
    return F.col(column).ilike(f"%{text}%")


def _start(page: int, size: int) -> int:
    """Rows before a page."""
    if page < 1:
        raise ValueError("page must be 1 or more")
    if not 1 <= size <= 500:
        raise ValueError("page_size must be within 1..500")
    return (page - 1) * size


def _cut(rows: DataFrame, order: list, start: int, size: int) -> DataFrame:
    """``size`` rows after the first ``start`` in a total order.

    The first ones are a top list of at most ``size`` rows a task. Any others, near or
    far, are cut from the sorted rows by position: an offset would carry all rows before the
    page into one task.
    """
    if not start:
        return rows.orderBy(*order).limit(size)
    at = F.col("_at")
    return (
        with_position(rows, order, "_at")
        .filter((at > start) & (at <= start + size))
        .orderBy(at)
        .drop("_at")
    )


def _page(rows: DataFrame, counted: DataFrame, order: list, page: int, size: int) -> DataFrame:
    """One page in a total order, every row with the total row count of ``counted``."""
    count = counted.agg(F.count(F.lit(1)).alias("total")).scalar()
    return _cut(rows, order, _start(page, size), size).withColumn("total", count)


def matching_employees(
    employees: DataFrame, department: str | None = None, status: str | None = None
) -> DataFrame:
    """The employees a page is cut from; empty filters do not filter."""
    if department:
        employees = employees.filter(_contains("department", department))
    if status:
        employees = employees.filter(F.col("status") == status)
    return employees


def employees_page(
    employees: DataFrame,
    page: int = 1,
    page_size: int = 50,
    department: str | None = None,
    status: str | None = None,
) -> DataFrame:
    """Directory page by last and first name, with the number of matching employees."""
    rows = matching_employees(employees, department, status).select(*_profile(employees))
    order = ["last_name", "first_name", "employee_id"]
    return _page(rows, rows, order, page, page_size)


def employee_profiles(
    logs: DataFrame, employees: DataFrame, employee_id: str | None = None
) -> DataFrame:
    """Profiles with shift totals; employees without shifts have 0 shifts and null sums.

    With ``employee_id`` only that profile, and no row when nobody has the id.
    """
    if employee_id is not None:
        logs = logs.filter(F.col("employee_id") == employee_id)
        employees = employees.filter(F.col("employee_id") == employee_id)
    sums = logs.groupBy("employee_id").agg(
        F.count("log_id").alias("_shifts"),
        total("hours_worked").alias("total_hours"),
        total("overtime_hours").alias("total_overtime"),
        total("gross_pay").alias("total_gross_pay"),
    )
    return employees.join(sums, "employee_id", "left").select(
        *_profile(employees),
        F.coalesce("_shifts", F.lit(0)).alias("total_shifts"),
        "total_hours",
        "total_overtime",
        "total_gross_pay",
    )


def matching_payroll(
    payroll: DataFrame, department: str | None = None, week_start: date | str | None = None
) -> DataFrame:
    """The payroll rows a page is cut from; the department is the payroll row's."""
    if department:
        payroll = payroll.filter(_contains("department", department))
    if week_start:
        payroll = payroll.filter(F.col("week_start") == F.lit(week_start).cast("date"))
    return payroll


def payroll_page(
    payroll: DataFrame,
    employees: DataFrame,
    page: int = 1,
    page_size: int = 50,
    department: str | None = None,
    week_start: date | str | None = None,
) -> DataFrame:
    """Payroll page with names, latest week and highest pay first.

    The total counts payroll rows, also those whose employee is not in the directory.
    """
    rows = matching_payroll(payroll, department, week_start)
    return _page(_named(rows, employees), rows, _payroll_order(), page, page_size)


def _named(payroll: DataFrame, employees: DataFrame) -> DataFrame:
    names = employees.select("employee_id", full_name().alias("full_name"))
    return payroll.join(names, "employee_id")


def _payroll_order() -> list:
    return [F.desc("week_start"), F.desc("total_gross_pay"), "employee_id", "department"]


def payroll_page_by_week(
    payroll: DataFrame,
    employees: DataFrame,
    page: int = 1,
    page_size: int = 50,
    department: str | None = None,
    week_start: date | str | None = None,
) -> DataFrame:
    """The page that ``payroll_page`` gives, from payroll stored by week.

    Weeks lead the order, so a count of each week's rows tells which weeks a page lies in.
    Only those are read whole and sorted, for the last page as for the first; the counts take
    a pass over ids and weeks, run when this is called, and are as many as the calendar has
    weeks. An employee id is in the directory once.
    """
    start, total, before = _start(page, page_size), 0, 0
    rows = matching_payroll(payroll, department, week_start)
    known = employees.select("employee_id", F.lit(True).alias("_known"))
    counts = (
        rows.select("employee_id", "week_start")
        .join(known, "employee_id", "left")
        .groupBy("week_start")
        .agg(F.count("_known").alias("listed"), F.count(F.lit(1)).alias("held"))
        .orderBy(F.desc("week_start"))
        .collect()
    )
    weeks, skipped = [], 0
    for week in counts:
        if before + week.listed <= start:
            skipped = before + week.listed
        elif before < start + page_size:
            weeks.append(week.week_start)
        before += week.listed
        total += week.held
    within = F.col("week_start").isin([w for w in weeks if w is not None])
    if None in weeks:
        within |= F.col("week_start").isNull()
    found = _named(rows.filter(within), employees)
    return _cut(found, _payroll_order(), start - skipped, page_size).withColumn(
        "total", F.lit(total).cast("bigint")
    )


def top_overtime(
    logs: DataFrame, employees: DataFrame, limit: int = 25, department: str | None = None
) -> DataFrame:
    """Employees with the most overtime, ranked by exact overtime hours.

    The department filter is on the shift, the department shown is the employee's.
    Everybody with more overtime than a listed employee is listed as well, so ranks
    are taken after the limit.
    """
    if not 1 <= limit <= 200:
        raise ValueError("limit must be within 1..200")
    if department:
        logs = logs.filter(_contains("department", department))
    sums = logs.groupBy("employee_id").agg(
        total("hours_worked").alias("total_hours"),
        F.sum("overtime_hours").alias("_exact"),
        total("overtime_pay").alias("total_overtime_cost"),
    )
    listed = (
        employees.join(sums, "employee_id")
        .orderBy(F.desc("_exact"), "employee_id")
        .limit(limit)
    )
    return listed.select(
        "employee_id",
        full_name().alias("full_name"),
        "department",
        "pay_rate",
        "total_hours",
        half_up(F.col("_exact"), 2).alias("total_overtime_hours"),
        "total_overtime_cost",
        F.rank().over(Window.orderBy(F.desc("_exact"))).cast("bigint").alias("overtime_rank"),
    ).orderBy(F.desc("total_overtime_hours"), "overtime_rank", "employee_id")


def badged_top_overtime(logs: DataFrame, employees: DataFrame, limit: int = 10) -> DataFrame:
    """Top list with its line number and the badge of the first three lines."""
    line = F.row_number().over(Window.orderBy("overtime_rank", "employee_id"))
    return (
        top_overtime(logs, employees, limit)
        .withColumn("line", line.cast("bigint"))
        .withColumn(
            "badge",
            F.when(F.col("line") == 1, "gold")
            .when(F.col("line") == 2, "silver")
            .when(F.col("line") == 3, "bronze"),
        )
    )

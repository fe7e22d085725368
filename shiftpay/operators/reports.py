"""Report queries over the directory and the processed shifts.

``logs`` is always the processed shift table and ``employees`` the directory.
Reports that join the two first add up the shifts per employee, so the join meets
one row per employee however many shifts one of them has.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from shiftpay.functions.columns import (
    COUNT,
    full_name,
    half_up,
    mean,
    month_of,
    ratio,
    total,
    week_of,
)
from shiftpay.functions.ranking import dense_rank_within, rank_all, tile

ACTIVE = "Active"
OVERTIME_FLOOR = Decimal("50")


def hours_per_employee(logs: DataFrame, employees: DataFrame) -> DataFrame:
    """Shifts, hours, overtime and pay of each active employee with shifts."""
    sums = logs.groupBy("employee_id").agg(
        F.count("log_id").alias("total_shifts"),
        total("hours_worked").alias("total_hours"),
        total("overtime_hours").alias("total_overtime_hours"),
        total("gross_pay").alias("total_gross_pay"),
    )
    return (
        employees.filter(F.col("status") == ACTIVE)
        .join(sums, "employee_id")
        .select(
            "employee_id",
            full_name().alias("full_name"),
            "department",
            "total_shifts",
            "total_hours",
            "total_overtime_hours",
            "total_gross_pay",
        )
        .orderBy(F.desc("total_hours"), "employee_id")
    )


def overtime_by_department(logs: DataFrame, floor: Decimal = OVERTIME_FLOOR) -> DataFrame:
    """Overtime shifts of departments with more than ``floor`` overtime hours."""
    return (
        logs.filter(F.col("overtime_hours") > 0)
        .groupBy("department")
        .agg(
            F.count_distinct("employee_id").alias("total_employees"),
            F.count("log_id").alias("total_shifts"),
            F.sum("overtime_hours").alias("_exact"),
            mean("overtime_hours", 4).alias("avg_overtime_per_shift"),
            total("overtime_pay").alias("total_overtime_cost"),
        )
        .filter(F.col("_exact") > F.lit(floor))
        .select(
            "department",
            "total_employees",
            "total_shifts",
            half_up(F.col("_exact"), 2).alias("total_overtime_hours"),
            "avg_overtime_per_shift",
            "total_overtime_cost",
        )
        .orderBy(F.desc("total_overtime_hours"), "department")
    )


def cost_by_month(logs: DataFrame) -> DataFrame:
    """Cost per department and month with the effective hourly rate."""
    return (
        logs.groupBy("department", month_of(F.col("log_date")).alias("pay_month"))
        .agg(
            F.count_distinct("employee_id").alias("active_employees"),
            total("hours_worked").alias("total_hours"),
            total("gross_pay").alias("total_payroll_cost"),
            mean("gross_pay", 2).alias("avg_shift_cost"),
            ratio(F.sum("gross_pay"), F.sum("hours_worked"), 2).alias("effective_hourly_rate"),
        )
        .orderBy(F.desc("pay_month"), F.desc("total_payroll_cost"), "department")
    )


def rank_by_hours(logs: DataFrame, employees: DataFrame) -> DataFrame:
    """Company rank, rank within the department and quartile by exact hours."""
    hours = logs.groupBy("employee_id").agg(F.sum("hours_worked").alias("hours"))
    names = employees.select("employee_id", "department", full_name().alias("full_name"))
    ranked = rank_all(hours.join(names, "employee_id"), "hours", "employee_id")
    return (
        dense_rank_within(ranked, "department", "hours")
        .select(
            "employee_id",
            "full_name",
            "department",
            half_up(F.col("hours"), 2).alias("total_hours"),
            "company_rank",
            "dept_rank",
            tile(F.col("position"), F.col("total_rows"), 4).alias("quartile"),
        )
        .orderBy("company_rank", "employee_id")
    )


def weekly_payroll(logs: DataFrame) -> DataFrame:
    """Payroll, overtime cost, hours and staff per week with the running payroll.

    The running total is over weeks, so its single window task sees one row per
    calendar week.
    """
    weeks = logs.groupBy(week_of(F.col("log_date")).alias("week_start")).agg(
        F.sum("gross_pay").alias("_gross"),
        total("overtime_pay").alias("weekly_overtime_cost"),
        total("hours_worked").alias("weekly_hours"),
        F.count_distinct("employee_id").alias("employees_paid"),
    )
    running = F.sum("_gross").over(Window.orderBy("week_start"))
    return weeks.select(
        "week_start",
        half_up(F.col("_gross"), 2).alias("weekly_payroll"),
        "weekly_overtime_cost",
        "weekly_hours",
        half_up(running, 2).alias("cumulative_payroll"),
        "employees_paid",
    )


def running_payroll(logs: DataFrame) -> DataFrame:
    return (
        weekly_payroll(logs)
        .select("week_start", "weekly_payroll", "cumulative_payroll", "employees_paid")
        .orderBy("week_start")
    )


def weekly_trend(logs: DataFrame, weeks: int = 12) -> DataFrame:
    """The last ``weeks`` weeks in time order; the running total covers all history."""
    if not 1 <= weeks <= 52:
        raise ValueError("weeks must be within 1..52")
    return weekly_payroll(logs).orderBy(F.desc("week_start")).limit(weeks).orderBy("week_start")


def department_overview(logs: DataFrame) -> DataFrame:
    """Every per-department measure of the reports below, in one pass over the shifts."""
    overtime_shifts = F.count_if(F.col("overtime_hours") > 0)
    return logs.groupBy("department").agg(
        F.count_distinct("employee_id").alias("total_employees"),
        F.count("log_id").alias("total_shifts"),
        overtime_shifts.alias("overtime_shifts"),
        total("hours_worked").alias("total_hours"),
        total("overtime_hours").alias("total_overtime_hours"),
        total("gross_pay").alias("total_gross_pay"),
        total("overtime_pay").alias("total_overtime_cost"),
        mean("pay_rate", 2).alias("avg_pay_rate"),
        mean("overtime_hours", 4).alias("avg_overtime_per_shift"),
        ratio(F.sum("gross_pay"), F.sum("hours_worked"), 2).alias("effective_hourly_rate"),
        ratio(overtime_shifts.cast(COUNT), F.count("log_id").cast(COUNT), 2, 100).alias(
            "overtime_rate_pct"
        ),
        ratio(F.sum("overtime_pay"), F.sum("gross_pay"), 2, 100).alias("overtime_cost_pct"),
        ratio(F.sum("overtime_hours"), F.sum("hours_worked"), 2, 100).alias("ot_rate_pct"),
    )


def overtime_pct(logs: DataFrame) -> DataFrame:
    """Share of overtime shifts and of overtime pay per department."""
    return (
        department_overview(logs)
        .select(
            "department",
            "total_shifts",
            "overtime_shifts",
            "overtime_rate_pct",
            "overtime_cost_pct",
        )
        .orderBy(F.desc("overtime_rate_pct"), "department")
    )


def department_summary(logs: DataFrame) -> DataFrame:
    """Headcount, hours, pay and rates per department, costliest first."""
    return (
        department_overview(logs)
        .select(
            "department",
            "total_employees",
            "total_hours",
            "total_overtime_hours",
            "total_gross_pay",
            "avg_pay_rate",
            "effective_hourly_rate",
        )
        .orderBy(F.desc("total_gross_pay"), "department")
    )


def overtime_report(logs: DataFrame) -> DataFrame:
    """Overtime hours, cost and rates per department; the average is over all shifts."""
    return (
        department_overview(logs)
        .select(
            "department",
            "total_shifts",
            "overtime_shifts",
            "total_overtime_hours",
            "avg_overtime_per_shift",
            "total_overtime_cost",
            "overtime_rate_pct",
            "overtime_cost_pct",
        )
        .orderBy(F.desc("total_overtime_hours"), "department")
    )


def top_departments(logs: DataFrame, limit: int = 10) -> DataFrame:
    """Departments with the most employees, and their cost."""
    return (
        department_overview(logs)
        .select(
            "department",
            F.col("total_employees").alias("headcount"),
            F.col("total_gross_pay").alias("total_cost"),
            "avg_pay_rate",
            "ot_rate_pct",
        )
        .orderBy(F.desc("headcount"), "department")
        .limit(limit)
    )


def _employee_costs(logs: DataFrame, employees: DataFrame) -> DataFrame:
    sums = logs.groupBy("employee_id").agg(
        total("hours_worked").alias("total_hours"),
        total("gross_pay").alias("total_cost"),
        total("overtime_pay").alias("total_overtime_cost"),
    )
    return employees.join(sums, "employee_id").select(
        "employee_id",
        full_name().alias("full_name"),
        "department",
        "pay_rate",
        "total_hours",
        "total_cost",
        "total_overtime_cost",
    )


def _rank(column: str) -> Column:
    return F.rank().over(Window.orderBy(F.desc(column))).cast("bigint")


def costliest_employees(logs: DataFrame, employees: DataFrame, ranks: int = 10) -> DataFrame:
    """Employees of cost rank 1..``ranks``; ties share a rank, so there may be more.

    The first ``ranks`` employees in a total order hold every cost that can have
    such a rank, and everybody above each of them. Ranks are therefore taken from
    those few rows and joined back by cost, which keeps ties of any size spread out.
    """
    costs = _employee_costs(logs, employees)
    top = costs.orderBy(F.desc("total_cost"), *[c for c in costs.columns if c != "total_cost"])
    ranked = (
        top.limit(ranks)
        .select("total_cost", _rank("total_cost").alias("cost_rank"))
        .distinct()
    )
    return costs.join(F.broadcast(ranked), "total_cost").select(
        *costs.columns, "cost_rank"
    ).orderBy("cost_rank", "employee_id")


def attendance_streaks(logs: DataFrame) -> DataFrame:
    """Days worked per employee, the gap since the day before and the streak status.

    The days are spread by ranges of employees, which serves the window and the final
    order alike: both need no further shuffle.
    """
    days = logs.select("employee_id", "log_date").distinct().repartitionByRange("employee_id")
    earlier = F.lag("log_date").over(Window.partitionBy("employee_id").orderBy("log_date"))
    gap = F.col("gap_days")
    return (
        days.withColumn("prev_date", earlier)
        .withColumn("gap_days", F.datediff("log_date", "prev_date").cast("bigint"))
        .withColumn(
            "streak_status",
            F.when(gap.isNull() | (gap > 1), "NEW_STREAK").otherwise("CONTINUING"),
        )
        .orderBy("employee_id", "log_date")
    )


def department_month_running(logs: DataFrame) -> DataFrame:
    """Payroll per department and month with the department's running total."""
    months = logs.groupBy("department", month_of(F.col("log_date")).alias("pay_month")).agg(
        F.count_distinct("employee_id").alias("active_employees"),
        total("hours_worked").alias("total_hours"),
        F.sum("gross_pay").alias("_gross"),
    )
    running = F.sum("_gross").over(Window.partitionBy("department").orderBy("pay_month"))
    return months.select(
        "department",
        "pay_month",
        "active_employees",
        "total_hours",
        half_up(F.col("_gross"), 2).alias("total_payroll"),
        half_up(running, 2).alias("cumulative_dept_payroll"),
    ).orderBy("department", "pay_month")


def overtime_histogram(logs: DataFrame) -> DataFrame:
    """Shifts per overtime bucket; overtime below 0.01 hours falls in no bucket (null)."""
    hours = F.col("overtime_hours")

    def within(low: str, high: str):
        return hours.between(F.lit(Decimal(low)), F.lit(Decimal(high)))

    bucket = (
        F.when(hours == 0, "0 hrs")
        .when(within("0.01", "1"), "0-1 hrs")
        .when(within("1", "2"), "1-2 hrs")
        .when(within("2", "4"), "2-4 hrs")
        .when(hours > 4, "4+ hrs")
    )
    return (
        logs.groupBy(bucket.alias("overtime_bucket"))
        .agg(
            F.count(F.lit(1)).alias("shift_count"),
            mean("gross_pay", 2).alias("avg_gross_pay"),
            total("overtime_pay").alias("total_overtime_cost"),
        )
        .orderBy(F.desc("shift_count"), "overtime_bucket")
    )


def moving_average(logs: DataFrame, weeks: int = 4) -> DataFrame:
    """Payroll per week (from Sunday) and its mean over the last ``weeks`` weeks."""
    payroll = logs.groupBy(week_of(F.col("log_date"), "sun").alias("week_start")).agg(
        F.sum("gross_pay").alias("_gross")
    )
    last = Window.orderBy("week_start").rowsBetween(1 - weeks, Window.currentRow)
    average = ratio(F.sum("_gross").over(last), F.count("_gross").over(last).cast(COUNT), 2)
    return payroll.select(
        "week_start",
        half_up(F.col("_gross"), 2).alias("actual_payroll"),
        average.alias("moving_avg_4wk"),
    ).orderBy("week_start")

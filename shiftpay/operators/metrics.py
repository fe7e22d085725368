"""Figures derived from the finished department reports.

They take the rounded report rows, as a reader of the reports would, and never go
back to the shifts. ``summary`` is the department summary, ``overtime`` the overtime
report; both have one row per department.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from shiftpay.functions.columns import ratio, total, total_or_zero
from shiftpay.operators.pay import OVERTIME_FACTOR

# Limits of the overtime flags in percent, and of an employee's hours.
HIGH_OVERTIME_PCT = 15
SEVERE_OVERTIME_PCT = 20
LONG_HOURS = 40


def _share(part: Column, whole: Column) -> Column:
    """Percentage at one decimal, 0 when there is nothing to divide by."""
    return F.coalesce(ratio(part, whole, 1, 100), F.lit(Decimal("0.0")))


def department_flags(summary: DataFrame) -> DataFrame:
    """Overtime hours in percent of hours (ties to even) and the high-overtime flag."""
    hours = F.col("total_hours")
    rate = F.when(
        hours > 0, F.bround(F.col("total_overtime_hours") * 100 / F.nullif(hours, F.lit(0)), 1)
    ).otherwise(F.lit(Decimal("0.0")))
    return summary.select(
        "department",
        "total_employees",
        "total_hours",
        "total_gross_pay",
        rate.alias("overtime_rate_pct"),
    ).withColumn(
        "flag", F.when(F.col("overtime_rate_pct") > HIGH_OVERTIME_PCT, "HIGH OT").otherwise("")
    )


def high_overtime_departments(summary: DataFrame) -> DataFrame:
    """The flagged departments, costliest first."""
    return (
        department_flags(summary)
        .filter(F.col("flag") != "")
        .orderBy(F.desc("total_gross_pay"), "department")
    )


def overtime_severity(overtime: DataFrame) -> DataFrame:
    """Overtime rows with the severity flag and the company's overtime hours and cost."""
    departments = Window.partitionBy()
    return overtime.select(
        "department",
        "overtime_shifts",
        "total_overtime_hours",
        "total_overtime_cost",
        "overtime_rate_pct",
        F.coalesce(F.col("overtime_rate_pct") > SEVERE_OVERTIME_PCT, F.lit(False)).alias("severe"),
        F.sum("total_overtime_hours").over(departments).alias("company_overtime_hours"),
        F.sum("total_overtime_cost").over(departments).alias("company_overtime_cost"),
    ).orderBy(F.desc("total_overtime_hours"), "department")


def company_kpis(overview: DataFrame) -> DataFrame:
    """Company totals, overtime shares and the costliest department (first by name on ties)."""
    costliest = F.min(F.struct((-F.col("total_gross_pay")).alias("pay"), F.col("department")))
    return overview.agg(
        total_or_zero("total_gross_pay").alias("total_payroll"),
        total_or_zero("total_hours").alias("total_hours"),
        total_or_zero("total_overtime_hours").alias("total_overtime_hours"),
        total_or_zero("total_overtime_cost").alias("total_overtime_cost"),
        costliest["department"].alias("costliest_department"),
    ).select(
        "total_payroll",
        "total_hours",
        "total_overtime_hours",
        "total_overtime_cost",
        _share(F.col("total_overtime_hours"), F.col("total_hours")).alias("overtime_rate_pct"),
        _share(F.col("total_overtime_cost"), F.col("total_payroll")).alias("overtime_pay_pct"),
        "costliest_department",
    )


def dashboard_kpis(summary: DataFrame, errors: DataFrame) -> DataFrame:
    """Payroll, hours, overtime share, number of departments and of flagged rows."""
    return summary.agg(
        total_or_zero("total_gross_pay").alias("total_payroll"),
        total_or_zero("total_hours").alias("total_hours"),
        ratio(F.sum("total_overtime_hours"), F.sum("total_hours"), 1, 100).alias("overtime_pct"),
        F.count(F.lit(1)).alias("departments"),
    ).withColumn("error_count", errors.agg(F.count(F.lit(1)).alias("n")).scalar())


def pay_split_estimate(summary: DataFrame) -> DataFrame:
    """Overtime pay estimated from the average rate, and the rest as regular pay."""
    estimate = (
        F.col("total_overtime_hours")
        * F.coalesce("avg_pay_rate", F.lit(Decimal("0")))
        * F.lit(OVERTIME_FACTOR)
    )
    return summary.select(
        "department",
        "total_gross_pay",
        estimate.alias("overtime_pay_estimate"),
        (F.col("total_gross_pay") - estimate).alias("regular_pay_estimate"),
    ).orderBy(F.desc("total_gross_pay"), "department")


def top_overtime_rate(overtime: DataFrame, limit: int = 8) -> DataFrame:
    """Departments with the highest share of overtime shifts."""
    return (
        overtime.select("department", "overtime_rate_pct")
        .orderBy(F.desc("overtime_rate_pct"), "department")
        .limit(limit)
    )


def long_hours_flag(profiles: DataFrame) -> DataFrame:
    """Profiles with ``is_overtime``: more than 40 hours in total, false without shifts."""
    over = F.col("total_hours") > LONG_HOURS
    return profiles.withColumn("is_overtime", F.coalesce(over, F.lit(False)))


def report_departments(logs: DataFrame) -> DataFrame:
    """Department table of the daily report."""
    return (
        logs.groupBy("department")
        .agg(
            F.count("log_id").alias("shifts"),
            total("hours_worked").alias("total_hours"),
            total("overtime_hours").alias("total_ot"),
            total("gross_pay").alias("total_payroll"),
        )
        .orderBy(F.desc("total_payroll"), "department")
    )


def report_totals(logs: DataFrame) -> DataFrame:
    """Header figures of the daily report."""
    return logs.agg(
        F.count(F.lit(1)).alias("total_shifts"),
        F.count_distinct("employee_id").alias("total_employees"),
        total_or_zero("hours_worked").alias("total_hours"),
        total_or_zero("overtime_hours").alias("overtime_hours"),
        total_or_zero("gross_pay").alias("total_payroll"),
    )

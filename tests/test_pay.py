from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rows import by, logs, raw
from shiftpay import schemas
from shiftpay.functions.columns import micros_between, month_of, week_of
from shiftpay.operators import pay


def one(spark, **row):
    return logs(spark, row).first()


def test_schema_is_the_table_schema(spark):
    found = logs(spark, {})
    assert [(f.name, f.dataType) for f in found.schema.fields] == [
        (f.name, f.dataType) for f in schemas.TIME_LOGS.fields
    ]


@pytest.mark.parametrize(
    "seconds, hours, overtime",
    [
        (28800, "8.0000", "0.0000"),
        (28801, "8.0003", "0.0003"),
        (1800, "0.5000", "0.0000"),
        (86400, "24.0000", "16.0000"),
        (30000.25, "8.3334", "0.3334"),
        (0.18 + 3600, "1.0001", "0.0000"),
    ],
)
def test_hours(spark, seconds, hours, overtime):
    row = one(spark, seconds=seconds)
    assert (str(row.hours_worked), str(row.overtime_hours)) == (hours, overtime)
    assert row.regular_hours + row.overtime_hours == row.hours_worked


def test_pay_is_rounded_per_shift_with_ties_up(spark):
    # 0.5 h at 0.01 is half a cent.
    assert one(spark, seconds=1800, pay_rate=Decimal("0.01")).regular_pay == Decimal("0.01")
    row = one(spark, seconds=9 * 3600, pay_rate=Decimal("33.33"))
    assert row.regular_pay == Decimal("266.64")
    assert row.overtime_pay == Decimal("50.00")
    assert row.gross_pay == row.regular_pay + row.overtime_pay


def test_limits_are_parameters(spark):
    clean = raw(spark, {"seconds": 9 * 3600, "pay_rate": Decimal("10.00")}).drop("n")
    row = pay.transform(clean, Decimal("6"), Decimal("2")).first()
    assert (row.regular_pay, row.overtime_pay) == (Decimal("60.00"), Decimal("60.00"))


def test_missing_department_is_named(spark):
    assert one(spark, department=None).department == "UNKNOWN"


def test_night_shift_belongs_to_its_first_day(spark):
    row = one(spark, clock_in=datetime(2024, 1, 7, 22), seconds=8 * 3600)
    assert row.clock_out == datetime(2024, 1, 8, 6)
    assert row.log_date == date(2024, 1, 7)


def test_lengths_ignore_the_session_zone(spark):
    rows = spark.sql(
        "select timestamp_ntz'2024-03-10 00:00:00' a, timestamp_ntz'2024-03-10 06:00:00.5' b"
    )
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert rows.select(micros_between("a", "b")).first()[0] == 21_600_500_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_weeks_start_on_monday_or_sunday(spark):
    days = spark.sql("select explode(sequence(date'2024-01-06', date'2024-01-08')) d")
    found = days.select(
        week_of(F.col("d")).alias("m"), week_of(F.col("d"), "sun").alias("s"), month_of(F.col("d"))
    ).collect()
    assert [(r.m.day, r.s.day) for r in found] == [(1, 31), (1, 7), (8, 7)]
    with pytest.raises(ValueError):
        week_of(F.col("d"), "tue")


def _two_departments(spark):
    return logs(
        spark,
        {"department": "B", "clock_in": datetime(2024, 1, 1, 8)},
        {"department": "A", "clock_in": datetime(2024, 1, 2, 8)},
        {"department": "A", "clock_in": datetime(2024, 1, 8, 8), "seconds": 10 * 3600},
        {"department": "B", "clock_in": datetime(2024, 1, 9, 8)},
    )


def test_payroll_summary_and_fold(spark):
    summary = pay.payroll_summary(_two_departments(spark))
    assert [(f.name, f.dataType) for f in summary.schema.fields] == [
        (f.name, f.dataType) for f in schemas.PAYROLL.fields
    ]
    assert summary.count() == 4
    folded = {r.week_start: r for r in pay.fold_payroll(summary).collect()}
    first, second = folded[date(2024, 1, 1)], folded[date(2024, 1, 8)]
    # Equal hours: the first name; otherwise the department with more hours.
    assert (first.department, first.num_shifts, first.total_hours) == ("A", 2, Decimal("16.00"))
    assert (second.department, second.total_overtime) == ("A", Decimal("2.00"))


def test_sums_agree(spark):
    shifts = _two_departments(spark)
    summary = pay.payroll_summary(shifts)
    totals = pay.run_totals(shifts).first()
    sums = summary.agg(F.sum("total_gross_pay"), F.sum("total_hours"), F.sum("num_shifts")).first()
    assert tuple(sums) == (totals.total_gross_pay, totals.total_hours, totals.transformed_logs)


def test_transform_stats(spark):
    clean = raw(spark, {"seconds": 7200}, {"seconds": 36000, "department": None}).drop("n")
    row = pay.transform_stats(clean).first()
    assert (row.avg_hours, row.avg_gross_pay) == (Decimal("6.00"), Decimal("130.00"))
    assert (row.total_overtime_hours, row.departments_filled) == (Decimal("2.0"), 1)
    assert by(pay.transform(clean), "department", "log_id") == {"A": "L0", "UNKNOWN": "L1"}

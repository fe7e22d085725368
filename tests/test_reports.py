from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F
from pyspark.testing import assertDataFrameEqual

from rows import by, logs, staff
from shiftpay.functions.ranking import dense_rank_within, rank_all, tile
from shiftpay.operators import listings, metrics, pay, reports

HOUR = 3600


def _values(spark):
    """Ties across a tile border, several magnitudes, one value held by a third of all rows."""
    tied = [("T", 12.5, 60)]
    spread = spark.range(0, 120).selectExpr(
        "concat('E', lpad(cast(id as string), 9, '0')) as employee_id",
        "concat('D', cast(id % 3 as string)) as department",
        "cast(pow(1.13, id) + id % 4 / 10 as decimal(16,4)) as hours",
    )
    same = spark.createDataFrame(tied, "p string, h double, n int").selectExpr(
        "explode(sequence(1, n)) as i", "h"
    ).selectExpr(
        "concat('E1', lpad(cast(i * 37 % 61 as string), 8, '0')) as employee_id",
        "'D1' as department",
        "cast(h as decimal(16,4)) as hours",
    )
    return spread.unionByName(same)


def test_ranks_equal_plain_windows(spark):
    rows = _values(spark)
    found = (
        rank_all(rows, "hours", "employee_id")
        .join(
            dense_rank_within(rows, "department", "hours").select(
                "employee_id", "dept_rank"
            ),
            "employee_id",
        )
        .withColumn("quartile", tile(F.col("position"), F.col("total_rows"), 4))
    )
    order = Window.orderBy(F.desc("hours"))
    total = Window.orderBy(F.desc("hours"), "employee_id")
    inside = Window.partitionBy("department").orderBy(F.desc("hours"))
    expected = rows.select(
        "*",
        F.rank().over(order).cast("bigint").alias("company_rank"),
        F.row_number().over(total).cast("bigint").alias("position"),
        F.dense_rank().over(inside).cast("bigint").alias("dept_rank"),
        F.ntile(4).over(total).cast("bigint").alias("quartile"),
    )
    assertDataFrameEqual(found.select(expected.columns), expected)


@pytest.mark.parametrize("rows", [1, 2, 3, 4, 5, 11])
def test_tiles(spark, rows):
    found = spark.range(1, rows + 1).select(
        "id",
        tile(F.col("id"), F.lit(rows).cast("bigint"), 4).alias("found"),
        F.ntile(4).over(Window.orderBy("id")).alias("expected"),
    )
    assert all(r.found == r.expected for r in found.collect())


@pytest.fixture(scope="module")
def people(spark):
    return staff(
        spark,
        {},
        {"status": "Inactive"},
        {"department": "B", "last_name": None},
        {"department": "C"},
    )


@pytest.fixture(scope="module")
def shifts(spark):
    return logs(
        spark,
        {"employee_id": "E1", "clock_in": datetime(2024, 1, 1, 8), "seconds": 10 * HOUR},
        {"employee_id": "E1", "clock_in": datetime(2024, 1, 2, 8), "seconds": 8 * HOUR},
        {"employee_id": "E1", "clock_in": datetime(2024, 1, 5, 8), "seconds": 8 * HOUR},
        {"employee_id": "E1", "clock_in": datetime(2024, 1, 5, 22), "seconds": 2 * HOUR},
        {"employee_id": "E2", "clock_in": datetime(2024, 1, 7, 8), "seconds": 12 * HOUR},
        {"employee_id": "E3", "clock_in": datetime(2024, 2, 1, 8), "seconds": 8 * HOUR, "department": "B"},
        {"employee_id": "E9", "clock_in": datetime(2024, 2, 2, 8), "seconds": 8 * HOUR, "department": "B"},
    )


def test_hours_of_active_employees(shifts, people):
    found = reports.hours_per_employee(shifts, people).collect()
    # E2 is not active, E4 has no shifts, E9 is not in the directory.
    assert [(r.employee_id, r.total_shifts, r.total_hours) for r in found] == [
        ("E1", 4, Decimal("28.00")),
        ("E3", 1, Decimal("8.00")),
    ]
    assert [r.full_name for r in found] == ["Ann Lee1", None]


def test_overtime_floor_is_on_the_exact_sum(shifts):
    found = reports.overtime_by_department(shifts, Decimal("5.9999")).collect()
    assert [(r.department, r.total_shifts, r.total_employees) for r in found] == [("A", 2, 2)]
    assert found[0].avg_overtime_per_shift == Decimal("3.0000")
    assert reports.overtime_by_department(shifts, Decimal("6")).count() == 0


def test_average_overtime_is_over_all_shifts_in_the_report(shifts):
    found = by(reports.overtime_report(shifts), "department", "avg_overtime_per_shift")
    assert found == {"A": Decimal("1.2000"), "B": Decimal("0.0000")}


def test_cost_by_month(shifts):
    found = reports.cost_by_month(shifts).collect()
    assert [(r.department, r.pay_month, r.active_employees) for r in found] == [
        ("B", date(2024, 2, 1), 2),
        ("A", date(2024, 1, 1), 2),
    ]
    assert found[0].effective_hourly_rate == Decimal("20.00")


def test_weeks(shifts):
    monday = reports.running_payroll(shifts).collect()
    assert [r.week_start.isoformat() for r in monday] == ["2024-01-01", "2024-01-29"]
    assert monday[-1].cumulative_payroll == sum(r.weekly_payroll for r in monday)
    sunday = [r.week_start.isoformat() for r in reports.moving_average(shifts).collect()]
    assert sunday == ["2023-12-31", "2024-01-07", "2024-01-28"]


def test_trend_keeps_the_running_total_of_hidden_weeks(shifts):
    last = reports.weekly_trend(shifts, 1).collect()
    every = reports.weekly_trend(shifts, 52).collect()
    assert last == every[-1:]
    assert last[0].cumulative_payroll > last[0].weekly_payroll
    for weeks in (0, 53):
        with pytest.raises(ValueError):
            reports.weekly_trend(shifts, weeks)


def test_moving_average_is_over_four_weeks(spark):
    shifts = logs(
        spark,
        *[
            {"clock_in": datetime(2024, 1, 7 + 7 * i, 8) if i < 3 else datetime(2024, 2, 7 * (i - 2) - 3, 8),
             "pay_rate": Decimal(10 * (i + 1))}
            for i in range(5)
        ],
    )
    found = [float(r.moving_avg_4wk) for r in reports.moving_average(shifts).collect()]
    assert found == [80.0, 120.0, 160.0, 200.0, 280.0]


def test_streaks(shifts):
    found = reports.attendance_streaks(shifts.filter("employee_id = 'E1'")).collect()
    assert [(r.log_date.day, r.gap_days, r.streak_status) for r in found] == [
        (1, None, "NEW_STREAK"),
        (2, 1, "CONTINUING"),
        (5, 3, "NEW_STREAK"),
    ]


def test_histogram_buckets(spark):
    overtime = [0, 0.5, HOUR, HOUR + 1, 2 * HOUR, 4 * HOUR, 4 * HOUR + 60, 1]
    shifts = logs(spark, *[{"seconds": 8 * HOUR + s} for s in overtime])
    found = by(reports.overtime_histogram(shifts), "overtime_bucket", "shift_count")
    # One second is 0.0003 hours, half a second 0.0001: below the first bucket.
    assert found == {"0 hrs": 1, "0-1 hrs": 1, "1-2 hrs": 2, "2-4 hrs": 1, "4+ hrs": 1, None: 2}


def test_cost_ranks_keep_ties(spark):
    people = staff(spark, *[{} for _ in range(14)])
    rates = [30] * 2 + [20] * 7 + [10] * 4 + [5]
    shifts = logs(
        spark,
        *[{"employee_id": f"E{i}", "pay_rate": Decimal(r)} for i, r in enumerate(rates, 1)],
    )
    ranks = [r.cost_rank for r in reports.costliest_employees(shifts, people).collect()]
    assert ranks == [1] * 2 + [3] * 7 + [10] * 4


def test_top_departments(shifts):
    found = reports.top_departments(shifts, 1).collect()
    assert [(r.department, r.headcount) for r in found] == [("A", 2)]


def test_employee_pages(people):
    def ids(**options):
        return [r.employee_id for r in listings.employees_page(people, **options).collect()]

    assert ids() == ["E3", "E1", "E2", "E4"]
    assert ids(page=2, page_size=3) == ["E4"]
    assert ids(department="a", status="Active") == ["E1"]
    assert ids(department="", status="") == ids()
    assert ids(department="_") == ids()
    assert {r.total for r in listings.employees_page(people, 1, 1).collect()} == {4}
    assert listings.matching_employees(people, "a").count() == 2
    for wrong in ({"page": 0}, {"page_size": 0}, {"page_size": 501}):
        with pytest.raises(ValueError):
            ids(**wrong)


def test_pages_add_up_to_the_whole(spark):
    people = staff(spark, *[{"last_name": f"N{i * 7 % 50}"} for i in range(57)]).repartition(5)
    found = [listings.employees_page(people, page, 10).collect() for page in range(1, 8)]
    order = people.orderBy("last_name", "first_name", "employee_id").collect()
    assert [r.employee_id for page in found for r in page] == [r.employee_id for r in order]
    assert [len(page) for page in found] == [10, 10, 10, 10, 10, 7, 0]
    assert {r.total for page in found for r in page} == {57}


def test_no_page_has_an_offset(spark):
    people = staff(spark, {}, {}, {})
    for page in (1, 2, 1900):
        plan = listings.employees_page(people, page, 500)._jdf.queryExecution().executedPlan()
        assert "offset" not in plan.toString().lower()


def test_ranks_of_many_ties_with_a_long_common_prefix(spark):
    rows = spark.range(100_000).selectExpr(
        "concat('EMPLOYEE-WITH-A-LONG-PREFIX-', lpad(id, 9, '0')) as employee_id",
        "cast(if(id < 99990, 8, id) as decimal(10,4)) as hours",
        "'D' as department",
    )
    ranked = dense_rank_within(rank_all(rows.repartition(4), "hours", "employee_id"), "department", "hours")
    counts = ranked.selectExpr(
        "count(distinct position) p", "max(position) m", "count_if(company_rank = 11) tied",
        "max(dept_rank) d", "max(total_rows) n", "count_if(hours = 8 and dept_rank = 11) last",
    ).first()
    assert tuple(counts) == (100_000, 100_000, 99_990, 11, 100_000, 99_990)


def test_pages_by_week_equal_plain_pages(spark, people):
    payroll = spark.sql(
        """SELECT concat('E', id % 5) employee_id, 'd' department, cast(id % 7 as decimal(10,2)) total_gross_pay,
             if(id % 11 = 0, null, date_add(date'2024-01-01', cast(7 * (id % 4) as int))) week_start
           FROM range(60)"""
    )
    pages = 0
    for page in range(1, 9):
        plain = listings.payroll_page(payroll, people, page, 8)
        found = listings.payroll_page_by_week(payroll, people, page, 8)
        assert found.collect() == plain.collect() and found.schema.names == plain.schema.names
        pages += not plain.isEmpty()
    assert pages > 2
    one = listings.payroll_page_by_week(payroll, people, 1, 8, week_start="2024-01-08")
    assert one.collect() == listings.payroll_page(payroll, people, 1, 8, week_start="2024-01-08").collect()
    assert listings.payroll_page_by_week(payroll.limit(0), people).count() == 0


def test_payroll_pages(shifts, people):
    payroll = pay.payroll_summary(shifts)
    found = listings.payroll_page(payroll, people).collect()
    assert [r.employee_id for r in found] == ["E3", "E1", "E2"]
    assert {r.total for r in found} == {4}
    week = listings.payroll_page(payroll, people, week_start="2024-01-01").collect()
    assert [r.employee_id for r in week] == ["E1", "E2"]
    assert listings.payroll_page(payroll, people, department="b").count() == 1


def test_top_overtime(shifts, people):
    found = listings.top_overtime(shifts, people, 2).collect()
    assert [(r.employee_id, r.overtime_rank) for r in found] == [("E2", 1), ("E1", 2)]
    there = listings.top_overtime(shifts, people, department="b").collect()
    assert [(r.employee_id, r.department) for r in there] == [("E3", "B")]
    badges = listings.badged_top_overtime(shifts, people).collect()
    assert [(r.line, r.badge) for r in badges] == [(1, "gold"), (2, "silver"), (3, "bronze")]
    for limit in (0, 201):
        with pytest.raises(ValueError):
            listings.top_overtime(shifts, people, limit)


def _summary(spark, *rows):
    columns = (
        "department string, total_employees bigint, total_hours decimal(17,2), "
        "total_overtime_hours decimal(17,2), total_gross_pay decimal(21,2), avg_pay_rate decimal(12,2)"
    )
    made = [(n, 1, Decimal(h), Decimal(o), Decimal(g), Decimal("10")) for n, h, o, g in rows]
    return spark.createDataFrame(made, columns)


def test_department_flags_round_ties_to_even(spark):
    summary = _summary(
        spark, ("A", "2000", "305", "3"), ("B", "2000", "301", "2"), ("C", "0", "0", "1"), ("D", "100", "15", "9")
    )
    found = metrics.department_flags(summary)
    assert by(found, "department", "overtime_rate_pct") == {
        "A": Decimal("15.2"), "B": Decimal("15.0"), "C": Decimal("0.0"), "D": Decimal("15.0"),
    }
    assert [r.department for r in metrics.high_overtime_departments(summary).collect()] == ["A"]


def test_company_figures(shifts):
    overview = reports.department_overview(shifts)
    row = metrics.company_kpis(overview).first()
    assert (row.total_hours, row.total_overtime_hours) == (Decimal("56.00"), Decimal("6.00"))
    assert (row.overtime_rate_pct, row.costliest_department) == (Decimal("10.7"), "A")
    summary = reports.department_summary(shifts)
    board = metrics.dashboard_kpis(summary, shifts.limit(3)).first()
    assert (board.departments, board.error_count, board.overtime_pct) == (2, 3, Decimal("10.7"))
    split = metrics.pay_split_estimate(summary).first()
    assert split.overtime_pay_estimate + split.regular_pay_estimate == split.total_gross_pay


def test_costliest_department_tie_is_first_by_name(spark):
    overview = _summary(spark, ("B", "1", "0", "5"), ("A", "1", "0", "5")).withColumn(
        "total_overtime_cost", F.lit(Decimal("0"))
    )
    assert metrics.company_kpis(overview).first().costliest_department == "A"


def test_severity_and_top_rates(shifts):
    overtime = reports.overtime_report(shifts)
    found = metrics.overtime_severity(overtime).collect()
    assert [(r.department, r.severe) for r in found] == [("A", True), ("B", False)]
    assert {r.company_overtime_hours for r in found} == {Decimal("6.00")}
    assert [r.department for r in metrics.top_overtime_rate(overtime, 1).collect()] == ["A"]


def test_daily_report(shifts):
    assert [r.department for r in metrics.report_departments(shifts).collect()] == ["A", "B"]
    row = metrics.report_totals(shifts).first()
    assert (row.total_shifts, row.total_employees) == (7, 4)
    assert by(metrics.report_departments(shifts), "department", "shifts") == {"A": 5, "B": 2}


def test_no_shifts(shifts, people):
    none = shifts.filter("false")
    assert metrics.report_totals(none).first().total_payroll == 0
    assert pay.run_totals(none).first().total_hours == 0
    assert reports.department_summary(none).count() == 0
    assert reports.rank_by_hours(none, people).count() == 0
    assert metrics.company_kpis(reports.department_overview(none)).first().overtime_rate_pct == 0

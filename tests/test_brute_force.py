"""Random small inputs against plain Python loops."""

import random
from collections import Counter
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest

from rows import raw
from shiftpay.operators import pay, quality, reports


def _random_rows(seed: int) -> list[dict]:
    pick = random.Random(seed)
    rows = []
    for number in range(250):
        start = datetime(2024, 1, 1) + timedelta(minutes=pick.randrange(60 * 24 * 40))
        length = pick.choice([None, 0, -600, 600, 1800, 28800, 28801, 86400, 86401, pick.randrange(90000)])
        rows.append(
            {
                "log_id": pick.choice([None, "HOT", *[f"L{i}" for i in range(120)]]),
                "employee_id": pick.choice([None, "", "E1", "E2", "E3", "E4"]),
                "clock_in": start,
                "clock_out": None if length is None else start + timedelta(seconds=length),
                "department": pick.choice([None, "A", "B"]),
                "pay_rate": Decimal(pick.randrange(1850, 8500)) / 100,
                "log_date": start.date(),
                "n": number,
            }
        )
    return rows


def _expected(rows: list[dict]) -> dict:
    seen, found = set(), {}
    for row in rows:
        length = None if row["clock_out"] is None else row["clock_out"] - row["clock_in"]
        if row["log_id"] in seen:
            why = "DUPLICATE_RECORD"
        elif not row["employee_id"]:
            why = "MISSING_EMPLOYEE_ID"
        elif length is None:
            why = "MISSING_CLOCK_OUT"
        elif length <= timedelta(0):
            why = "INVALID_CLOCK_SEQUENCE"
        elif not timedelta(minutes=30) <= length <= timedelta(days=1):
            why = "INVALID_HOURS"
        else:
            why = None
        seen.add(row["log_id"])
        found[row["n"]] = why
    return found


def _round(value: Decimal, digits: str) -> Decimal:
    return value.quantize(Decimal(digits), ROUND_HALF_UP)


def _pay(row: dict) -> tuple[Decimal, Decimal, Decimal]:
    seconds = Decimal((row["clock_out"] - row["clock_in"]).total_seconds())
    hours = _round(seconds / 3600, "0.0001")
    overtime = max(hours - 8, Decimal(0))
    regular = _round(min(hours, Decimal(8)) * row["pay_rate"], "0.01")
    extra = _round(overtime * row["pay_rate"] * Decimal("1.5"), "0.01")
    return hours, overtime, regular + extra


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("tasks", [1, 3])
def test_validation_and_pay(spark, seed, tasks):
    rows = _random_rows(seed)
    validated = quality.validate(raw(spark, *rows).repartition(tasks), ["n"])
    expected = _expected(rows)
    assert {r.n: r.error_reason for r in validated.collect()} == expected

    clean = [row for row in rows if expected[row["n"]] is None]
    logs = pay.transform(quality.clean_logs(validated))
    assert Counter(
        (r.log_id, r.hours_worked, r.overtime_hours, r.gross_pay) for r in logs.collect()
    ) == Counter((row["log_id"], *_pay(row)) for row in clean)

    weekly = Counter()
    for row in clean:
        monday = row["log_date"] - timedelta(days=row["log_date"].weekday())
        weekly[(row["employee_id"], monday, row["department"] or "UNKNOWN")] += _pay(row)[2]
    summary = pay.payroll_summary(logs).collect()
    assert {
        (r.employee_id, r.week_start, r.department): r.total_gross_pay for r in summary
    } == dict(weekly)

    days = sorted({(row["employee_id"], row["log_date"]) for row in clean})
    streaks = []
    for before, (who, day) in zip([(None, None), *days], days):
        gap = (day - before[1]).days if before[0] == who else None
        streaks.append((who, day, gap, "CONTINUING" if gap == 1 else "NEW_STREAK"))
    found = reports.attendance_streaks(logs).collect()
    assert [(r.employee_id, r.log_date, r.gap_days, r.streak_status) for r in found] == streaks

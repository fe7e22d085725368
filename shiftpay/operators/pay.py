"""Hours, overtime and pay per shift, and the weekly payroll rollup."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

from shiftpay import schemas
from shiftpay.functions.columns import (
    half_up,
    mean,
    micros_between,
    total_or_zero,
    week_of,
)

# Hours of a shift before overtime starts, and the overtime factor.
STANDARD_HOURS = Decimal("8")
OVERTIME_FACTOR = Decimal("1.5")
NO_DEPARTMENT = "UNKNOWN"

# One ten-thousandth of an hour, the unit of stored hours.
_HOUR_UNIT = Decimal("0.0001")
_MICROS_PER_UNIT = 360_000


def hours_between(start: str, end: str) -> Column:
    """Hours at four decimals, ties up, counted in integers (``end`` after ``start``)."""
    padded = micros_between(start, end) + _MICROS_PER_UNIT // 2
    units = F.call_function("div", padded, F.lit(_MICROS_PER_UNIT))
    return (units.cast("decimal(9,0)") * F.lit(_HOUR_UNIT)).cast(schemas.HOURS)


def transform(
    clean: DataFrame,
    standard_hours: Decimal = STANDARD_HOURS,
    overtime_factor: Decimal = OVERTIME_FACTOR,
) -> DataFrame:
    """Clean shifts with hours, overtime and pay; each amount is rounded per shift."""
    return _computed(clean, standard_hours, overtime_factor).drop("filled")


def _computed(clean: DataFrame, standard_hours: Decimal, overtime_factor: Decimal) -> DataFrame:
    """The processed columns, and ``filled``: whether the department was missing."""
    raw = schemas.names(schemas.RAW_LOGS)
    filled = {"department": f"coalesce(department, '{NO_DEPARTMENT}') as department"}
    return (
        clean.select(*raw, hours_between("clock_in", "clock_out").alias("hours_worked"))
        .selectExpr(
            *[filled.get(c, c) for c in raw],
            "department is null as filled",
            "hours_worked",
            f"cast(greatest(hours_worked - {standard_hours}, 0) as decimal(6,4)) as overtime_hours",
            f"cast(least(hours_worked, {standard_hours}) as decimal(6,4)) as regular_hours",
        )
        .selectExpr(
            "*",
            "cast(round(regular_hours * pay_rate, 2) as decimal(10,2)) as regular_pay",
            f"""cast(round(overtime_hours * pay_rate * {overtime_factor}, 2) as decimal(10,2))
                as overtime_pay""",
        )
        .selectExpr("*", "cast(regular_pay + overtime_pay as decimal(10,2)) as gross_pay")
    )


_PAYROLL_KEYS = ["employee_id", "week_start"]
# what is added up in a part
_SUMS = {f.name: f.dataType for f in schemas.PAYROLL_PART.fields if f.name != "department"}


def payroll_summary(logs: DataFrame) -> DataFrame:
    """Weekly totals per employee and department, weeks starting on Monday."""
    return summary_of_parts(payroll_parts(logs))


def payroll_parts(logs: DataFrame) -> DataFrame:
    """Exact sums per employee, week (from Monday) and department, not rounded yet."""
    return logs.groupBy(
        "employee_id", week_of(F.col("log_date")).alias("week_start"), "department"
    ).agg(
        F.sum("hours_worked").alias("hours"),
        F.sum("overtime_hours").alias("overtime"),
        F.sum("gross_pay").alias("gross"),
        F.count("log_id").alias("shifts"),
    )


def add_parts(parts: DataFrame) -> DataFrame:
    """Parts of the same employee, week and department as one: as if of all their shifts."""
    return parts.groupBy(*_PAYROLL_KEYS, "department").agg(
        *[F.sum(name).cast(kind).alias(name) for name, kind in _SUMS.items()]
    )


def joined_parts(one: Column, other: Column) -> Column:
    """Two lists of parts of an employee and week as one list, each department once."""
    both = F.concat(one, other)
    first, second = both[0], F.get(both, F.lit(1))
    departments = F.array_distinct(F.transform(both, lambda p: p["department"]))

    def of_department(department: Column) -> Column:
        same = F.filter(both, lambda p: p["department"].eqNullSafe(department))
        sums = [_added(same, lambda p, n=n: p[n], kind).alias(n) for n, kind in _SUMS.items()]
        return F.struct(department.alias("department"), *sums)

    # most employees stay in one department, so this is told apart without going through lists
    sums = [_plus(first[n], second[n], kind).alias(n) for n, kind in _SUMS.items()]
    alike = (F.size(both) == 2) & first["department"].eqNullSafe(second["department"])
    return F.when(alike, F.array(F.struct(first["department"].alias("department"), *sums))).otherwise(
        F.transform(departments, of_department)
    )


def _plus(a: Column, b: Column, kind: T.DataType) -> Column:
    """Sum that leaves out nulls, as one over rows does."""
    return F.coalesce((a + b).cast(kind), a, b)


def _added(parts: Column, value: Callable[[Column], Column], kind: T.DataType) -> Column:
    """Sum of ``value`` over a list of parts."""
    values = F.transform(parts, lambda p: value(p).cast(kind))
    return F.aggregate(values, F.lit(None).cast(kind), lambda a, v: _plus(a, v, kind))


def summary_of_parts(parts: DataFrame) -> DataFrame:
    """The payroll summary of the shifts that went into ``parts``."""
    return parts.select(*_PAYROLL_KEYS, "department", *_rounded())


def _rounded() -> list[Column]:
    return [*_round(F.col), F.lit("weekly").alias("pay_period")]


def _round(of: Callable[[str], Column]) -> list[Column]:
    return [
        half_up(of("hours"), 2).cast(schemas.TOTAL_HOURS).alias("total_hours"),
        half_up(of("overtime"), 2).cast(schemas.TOTAL_HOURS).alias("total_overtime"),
        half_up(of("gross"), 2).cast(schemas.TOTAL_PAY).alias("total_gross_pay"),
        of("shifts").cast("int").alias("num_shifts"),
    ]


def folded(row: str | None = None) -> list[Column]:
    """The columns of a payroll row from summary rows, or from those in the struct ``row``, where
    it is null on other rows."""
    of = (lambda n: F.col(f"{row}.{n}")) if row else F.col
    most_hours = F.struct((-of("total_hours")).alias("h"), of("department").alias("department"))
    if row:
        most_hours = F.when(F.col(row).isNotNull(), most_hours)
    return [
        F.min(most_hours)["department"].alias("department"),
        F.sum(of("total_hours")).cast(schemas.TOTAL_HOURS).alias("total_hours"),
        F.sum(of("total_overtime")).cast(schemas.TOTAL_HOURS).alias("total_overtime"),
        F.sum(of("total_gross_pay")).cast(schemas.TOTAL_PAY).alias("total_gross_pay"),
        F.sum(of("num_shifts")).cast("int").alias("num_shifts"),
        F.min(of("pay_period")).alias("pay_period"),
    ]


def fold_payroll(summary: DataFrame) -> DataFrame:
    """One row per employee and week: the key of the payroll table.

    Weeks worked in several departments are added up and carry the department with
    the most hours, on equal hours the first by name.
    """
    return summary.groupBy(*_PAYROLL_KEYS).agg(*folded())


def part_lists(parts: DataFrame) -> DataFrame:
    """The parts of each employee and week as a list, one for each department, so it is short."""
    part = F.struct(*schemas.names(schemas.PAYROLL_PART))
    return parts.groupBy(*_PAYROLL_KEYS).agg(F.collect_list(part).alias("parts"))


def folded_list(parts: str) -> list[Column]:
    """The columns of a payroll row from the list of its parts, as ``fold_payroll`` gives them."""
    only, alone = F.col(parts)[0], F.size(parts) == 1
    rows = F.transform(parts, lambda p: F.struct(p["department"].alias("department"), *_round(lambda n: p[n])))
    most_hours = F.transform(
        rows, lambda r: F.struct((-r["total_hours"]).alias("h"), r["department"].alias("department"))
    )
    sums = {f.name: f.dataType for f in schemas.PAYROLL.fields if f.name.startswith(("total_", "num_"))}
    single = dict(zip(sums, _round(lambda n: only[n])))
    return [
        F.when(alone, only["department"])
        .otherwise(F.array_min(most_hours)["department"])
        .alias("department"),
        *[
            F.when(alone, single[n]).otherwise(_added(rows, lambda r, n=n: r[n], kind)).alias(n)
            for n, kind in sums.items()
        ],
        F.lit("weekly").alias("pay_period"),
    ]


def run_totals(logs: DataFrame) -> DataFrame:
    """Rows, hours, overtime and gross pay of a run."""
    return logs.agg(
        F.count(F.lit(1)).alias("transformed_logs"),
        total_or_zero("hours_worked").alias("total_hours"),
        total_or_zero("overtime_hours").alias("total_overtime_hours"),
        total_or_zero("gross_pay").alias("total_gross_pay"),
    )


def transform_stats(
    clean: DataFrame,
    standard_hours: Decimal = STANDARD_HOURS,
    overtime_factor: Decimal = OVERTIME_FACTOR,
) -> DataFrame:
    """Mean hours and pay per shift, overtime hours, and departments filled in."""
    return _computed(clean, standard_hours, overtime_factor).agg(
        mean("hours_worked", 2).alias("avg_hours"),
        mean("gross_pay", 2).alias("avg_gross_pay"),
        half_up(F.sum("overtime_hours"), 1).alias("total_overtime_hours"),
        F.count_if("filled").alias("departments_filled"),
    )

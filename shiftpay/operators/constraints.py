"""Audits for the table constraints that files cannot enforce."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Rules:
    """Constraints of one table; the checks must not be false, null passes them."""

    required: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    checks: dict[str, Column | str] = field(default_factory=dict)


# Constraints of the four tables.
EMPLOYEES = Rules(
    required=(
        "employee_id", "first_name", "last_name", "department", "pay_rate", "hire_date", "status",
    ),
    unique=(("employee_id",), ("email",)),
    max_length={
        "employee_id": 10, "first_name": 100, "last_name": 100,
        "department": 100, "status": 20, "email": 200,
    },
    checks={
        "pay_rate_positive": "pay_rate > 0",
        "status_known": "status in ('Active', 'Inactive', 'On Leave')",
    },
)
RAW_LOGS = Rules(
    required=("log_id", "employee_id", "clock_in", "clock_out", "department", "pay_rate", "log_date"),
    unique=(("log_id",),),
    max_length={"log_id": 12, "employee_id": 10, "department": 100},
    checks={"clock_sequence": "clock_out > clock_in"},
)
TIME_LOGS = Rules(
    required=RAW_LOGS.required
    + (
        "hours_worked", "overtime_hours", "regular_hours",
        "regular_pay", "overtime_pay", "gross_pay",
    ),
    unique=RAW_LOGS.unique,
    max_length=RAW_LOGS.max_length,
    checks={
        **RAW_LOGS.checks,
        "hours_worked_positive": "hours_worked > 0",
        "overtime_hours_not_negative": "overtime_hours >= 0",
        "regular_hours_positive": "regular_hours > 0",
    },
)
PAYROLL = Rules(
    required=(
        "employee_id", "week_start", "department", "total_hours", "total_overtime",
        "total_gross_pay", "num_shifts", "pay_period",
    ),
    unique=(("employee_id", "week_start"),),
    max_length={"employee_id": 10, "department": 100, "pay_period": 20},
)
VALIDATION_ERRORS = Rules(
    required=("error_reason", "flagged_at"),
    max_length={
        "log_id": 12, "employee_id": 10, "department": 100,
        "error_reason": 100, "pipeline_run_id": 30,
    },
)


def audit(rows: DataFrame, table: str, rules: Rules) -> DataFrame:
    """One row per rule: table_name, rule, violations.

    All rules are judged in one scan and one shuffle. A row becomes one short entry for each
    row rule that it breaks and one for each of its keys; entries are added up before the
    shuffle, so broken rules are a row per task and only keys move. A uniqueness rule counts
    the keys that occur more than once; keys with a null part are unique by definition
    unless the part is required, which its own rule reports.
    """
    broken = {f"{c}_required": F.col(c).isNull() for c in rules.required}
    broken |= {f"{c}_length": F.char_length(c) > n for c, n in rules.max_length.items()}
    broken |= {
        name: ~(F.expr(check) if isinstance(check, str) else check)
        for name, check in rules.checks.items()
    }
    unique = {"_".join(key) + "_unique": key for key in rules.unique}
    parts = list(dict.fromkeys(c for key in rules.unique for c in key))
    none = {c: F.lit(None).cast(rows.schema[c].dataType) for c in parts}

    def entry(rule: str, applies: Column, key: tuple[str, ...] = ()) -> Column:
        values = [(F.col(c) if c in key else none[c]).alias(f"key{i}") for i, c in enumerate(parts)]
        return F.when(applies, F.struct(F.lit(rule).alias("rule"), *values))

    entries = [entry(rule, applies) for rule, applies in broken.items()]
    for rule, key in unique.items():
        whole = reduce(Column.__and__, [F.col(c).isNotNull() for c in key])
        entries.append(entry(rule, whole, key))
    counted = (
        rows.select(F.explode(F.array_compact(F.array(*entries))).alias("entry"))
        .groupBy("entry.rule", *[f"entry.key{i}" for i in range(len(parts))])
        .agg(F.count(F.lit(1)).alias("n"))
    )
    violations = [
        F.coalesce(F.sum(F.when(F.col("rule") == rule, F.col("n"))), F.lit(0)).alias(rule)
        for rule in broken
    ] + [F.count_if((F.col("rule") == rule) & (F.col("n") > 1)).alias(rule) for rule in unique]
    return (
        counted.agg(*violations)
        .unpivot([], [*broken, *unique], "rule", "violations")
        .select(F.lit(table).alias("table_name"), "rule", "violations")
    )


def violated(audits: DataFrame) -> DataFrame:
    """The rules that do not hold."""
    return audits.filter("violations > 0")


def orphans(rows: DataFrame, employees: DataFrame) -> DataFrame:
    """Rows of a table whose employee is not in the directory."""
    return rows.filter(F.col("employee_id").isNotNull()).join(
        employees.select("employee_id"), "employee_id", "left_anti"
    ).select(*rows.columns)

"""Fixed schemas of the tables; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

RATE = T.DecimalType(8, 2)
HOURS = T.DecimalType(6, 4)
PAY = T.DecimalType(10, 2)
TOTAL_HOURS = T.DecimalType(8, 2)
TOTAL_PAY = T.DecimalType(12, 2)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


EMPLOYEES = _struct(
    ("employee_id", T.StringType()),
    ("first_name", T.StringType()),
    ("last_name", T.StringType()),
    ("department", T.StringType()),
    ("pay_rate", RATE),
    ("hire_date", T.DateType()),
    ("status", T.StringType()),
    ("email", T.StringType()),
)

EMPLOYEE_TABLE = T.StructType(
    EMPLOYEES.fields
    + [
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

RAW_LOGS = _struct(
    ("log_id", T.StringType()),
    ("employee_id", T.StringType()),
    ("clock_in", T.TimestampNTZType()),
    ("clock_out", T.TimestampNTZType()),
    ("department", T.StringType()),
    ("pay_rate", RATE),
    ("log_date", T.DateType()),
)

TIME_LOGS = T.StructType(
    RAW_LOGS.fields
    + _struct(
        ("hours_worked", HOURS),
        ("overtime_hours", HOURS),
        ("regular_hours", HOURS),
        ("regular_pay", PAY),
        ("overtime_pay", PAY),
        ("gross_pay", PAY),
    ).fields
)

PAYROLL = _struct(
    ("employee_id", T.StringType()),
    ("week_start", T.DateType()),
    ("department", T.StringType()),
    ("total_hours", TOTAL_HOURS),
    ("total_overtime", TOTAL_HOURS),
    ("total_gross_pay", TOTAL_PAY),
    ("num_shifts", T.IntegerType()),
    ("pay_period", T.StringType()),
)

VALIDATION_ERRORS = T.StructType(
    RAW_LOGS.fields
    + _struct(
        ("error_reason", T.StringType()),
        ("flagged_at", T.TimestampType()),
        ("pipeline_run_id", T.StringType()),
    ).fields
)


def names(schema: T.StructType) -> list[str]:
    return [field.name for field in schema.fields]


def as_text(schema: T.StructType) -> T.StructType:
    """Same columns, all strings: how a CSV is read before the typed parse."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def with_fields(schema: T.StructType, **extra: T.DataType) -> T.StructType:
    return T.StructType(
        schema.fields + [T.StructField(name, kind) for name, kind in extra.items()]
    )


#: Payroll as it is stored: with the time a row was first written.
PAYROLL_TABLE = with_fields(PAYROLL, created_at=T.TimestampType())

#: Exact sums of an employee's shifts of a week in one department. Sums of such rows are exact too.
PAYROLL_PART = _struct(
    ("department", T.StringType()),
    ("hours", T.DecimalType(16, 4)),
    ("overtime", T.DecimalType(16, 4)),
    ("gross", T.DecimalType(20, 2)),
    ("shifts", T.LongType()),
)
#: What payroll files hold: beside each row the parts it was rounded from.
PAYROLL_FILE = with_fields(PAYROLL_TABLE, parts=T.ArrayType(PAYROLL_PART))

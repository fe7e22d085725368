"""Small hand-made inputs."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, types as T

from shiftpay import schemas

START = datetime(2024, 1, 3, 8)


def raw(spark: SparkSession, *rows: dict) -> DataFrame:
    """Raw shifts; what a row does not give is an ordinary eight-hour shift."""
    schema = schemas.with_fields(schemas.RAW_LOGS, n=T.LongType())
    names = schemas.names(schema)
    made = []
    for number, row in enumerate(rows):
        start = row.get("clock_in", START)
        full = {
            "log_id": f"L{number}",
            "employee_id": "E1",
            "clock_in": start,
            "clock_out": start + timedelta(hours=8) if start else START,
            "department": "A",
            "pay_rate": Decimal("20.00"),
            "log_date": start.date() if start else date(2024, 1, 3),
            "n": number,
            **row,
        }
        if "seconds" in row:
            full["clock_out"] = full["clock_in"] + timedelta(seconds=row["seconds"])
        made.append(tuple(full[c] for c in names))
    return spark.createDataFrame(made, schema)


def logs(spark: SparkSession, *rows: dict) -> DataFrame:
    """Processed shifts made from such rows."""
    from shiftpay.operators import pay

    return pay.transform(raw(spark, *rows).drop("n"))


def staff(spark: SparkSession, *rows: dict) -> DataFrame:
    names = schemas.names(schemas.EMPLOYEES)
    made = []
    for number, row in enumerate(rows, 1):
        full = {
            "employee_id": f"E{number}",
            "first_name": "Ann",
            "last_name": f"Lee{number}",
            "department": "A",
            "pay_rate": Decimal("20.00"),
            "hire_date": date(2020, 1, 1),
            "status": "Active",
            "email": f"e{number}@example.org",
            **row,
        }
        made.append(tuple(full[c] for c in names))
    return spark.createDataFrame(made, schemas.EMPLOYEES)


def by(rows: DataFrame, key: str, value: str) -> dict:
    return {r[key]: r[value] for r in rows.collect()}

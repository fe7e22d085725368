"""Column expressions shared by the operators."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, functions as F

COUNT = "decimal(20,0)"


def half_up(value: Column, digits: int) -> Column:
    """Decimal rounding, ties away from zero."""
    return F.round(value, digits)


def total(name: str, digits: int = 2) -> Column:
    """Rounded sum. Only the sum is rounded, never its parts."""
    return half_up(F.sum(name), digits)


def total_or_zero(name: str, digits: int = 2) -> Column:
    """Rounded sum of a whole table, 0 when it has no rows."""
    return half_up(F.coalesce(F.sum(name), F.lit(Decimal("0"))), digits)


def ratio(numerator: Column, denominator: Column, digits: int, times: int = 1) -> Column:
    """numerator * times / denominator in exact decimals; null when the denominator is 0."""
    return half_up(numerator * F.lit(times) / F.nullif(denominator, F.lit(0)), digits)


def mean(name: str, digits: int) -> Column:
    """Average rounded once: the built-in decimal avg would round before we do."""
    return ratio(F.sum(name), F.count(name).cast(COUNT), digits)


def week_of(day: Column, first: str = "mon") -> Column:
    """First day of the week holding ``day``; weeks start on Monday or on Sunday."""
    if first == "mon":
        return F.date_sub(day, F.weekday(day))
    if first == "sun":
        return F.date_sub(day, F.dayofweek(day) - 1)
    raise ValueError(f"weeks start 'mon' or 'sun', not {first!r}")


def month_of(day: Column) -> Column:
    return F.trunc(day, "month")


def micros_between(start: str, end: str) -> Column:
    """Length in microseconds from column ``start`` to ``end``, free of any time zone."""
    seconds = f"cast(cast({end} - {start} as interval second) as decimal(18,6))"
    return F.expr(f"cast({seconds} * 1000000 as bigint)")


def full_name() -> Column:
    """First and last name; null when either is, as string concatenation in SQL."""
    return F.concat(F.col("first_name"), F.lit(" "), F.col("last_name"))


def null_safe(left, right, keys: list[str]) -> Column:
    """Join condition on ``keys`` under which null equals null."""
    return reduce(
        lambda a, b: a & b, [left[key].eqNullSafe(right[key]) for key in keys]
    )

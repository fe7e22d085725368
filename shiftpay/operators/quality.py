"""Data-quality rules for raw shifts: one reason per row, first matching rule wins."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from shiftpay import schemas
from shiftpay.functions.columns import COUNT, micros_between, ratio
from shiftpay.functions.firsts import mark_repeats

# Reason names in rule order, and the accepted shift length in hours.
DUPLICATE = "DUPLICATE_RECORD"
NO_EMPLOYEE = "MISSING_EMPLOYEE_ID"
NO_CLOCK_OUT = "MISSING_CLOCK_OUT"
NO_CLOCK_IN = "MISSING_CLOCK_IN"
BAD_SEQUENCE = "INVALID_CLOCK_SEQUENCE"
BAD_HOURS = "INVALID_HOURS"
REASONS = (DUPLICATE, NO_EMPLOYEE, NO_CLOCK_OUT, NO_CLOCK_IN, BAD_SEQUENCE, BAD_HOURS)
MIN_HOURS = 0.5
MAX_HOURS = 24

_MICROS_PER_HOUR = 3_600_000_000
_REPEAT = "_is_repeat"


def missing_employee() -> Column:
    return F.col("employee_id").isNull() | (F.col("employee_id") == "")


def missing_clock_out() -> Column:
    return F.col("clock_out").isNull()


def missing_clock_in() -> Column:
    """Rows the length rules cannot judge; they are flagged instead of getting lost."""
    return F.col("clock_in").isNull()


def wrong_sequence() -> Column:
    return F.col("clock_out") <= F.col("clock_in")


def wrong_hours() -> Column:
    length = micros_between("clock_in", "clock_out")
    return (length < int(MIN_HOURS * _MICROS_PER_HOUR)) | (length > MAX_HOURS * _MICROS_PER_HOUR)


def reason(is_duplicate: Column) -> Column:
    """Reason of the first rule a row breaks, null for a clean row."""
    return (
        F.when(is_duplicate, DUPLICATE)
        .when(missing_employee(), NO_EMPLOYEE)
        .when(missing_clock_out(), NO_CLOCK_OUT)
        .when(missing_clock_in(), NO_CLOCK_IN)
        .when(wrong_sequence(), BAD_SEQUENCE)
        .when(wrong_hours(), BAD_HOURS)
    )


def validate(
    raw: DataFrame,
    ingest_order: list[str],
    seen: DataFrame | None = None,
    known_are_errors: bool = True,
) -> DataFrame:
    """Raw shifts with ``error_reason``; a row is a duplicate when its log_id came before.

    ``ingest_order`` names the columns that define which row came first. ``seen``
    (one column, log_id) lists ids of earlier loads, clean or flagged; with
    ``known_are_errors`` off rows of these are passed over.

    The reason is computed after the duplicate test, so a filter on it stays above
    the window: a repeat of an invalid row must be reported as a duplicate.
    """
    marked = mark_repeats(raw, "log_id", ingest_order, _REPEAT, seen, known_are_errors)
    return marked.withColumn("error_reason", reason(F.col(_REPEAT))).drop(_REPEAT)


def clean_logs(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("error_reason").isNull()).select(*schemas.names(schemas.RAW_LOGS))


def flagged(validated: DataFrame, rule: str | None = None) -> DataFrame:
    """Flagged rows, of one rule or of all, with every column of the input."""
    broken = F.col("error_reason")
    return validated.filter(broken.isNotNull() if rule is None else broken == rule)


def validation_errors(validated: DataFrame, run_id: str, flagged_at: datetime) -> DataFrame:
    """Flagged rows as the errors table holds them; one ``flagged_at`` for the run."""
    return flagged(validated).select(
        *schemas.names(schemas.RAW_LOGS),
        "error_reason",
        F.lit(flagged_at).cast("timestamp").alias("flagged_at"),
        F.lit(run_id).alias("pipeline_run_id"),
    )


def run_metrics(validated: DataFrame) -> DataFrame:
    """Rows in, clean and flagged, and the flagged share in percent (null without input)."""
    bad = F.count_if(F.col("error_reason").isNotNull())
    return validated.agg(
        F.count(F.lit(1)).alias("records_in"),
        F.count_if(F.col("error_reason").isNull()).alias("clean_records"),
        bad.alias("flagged_records"),
        ratio(bad.cast(COUNT), F.count(F.lit(1)).cast(COUNT), 2, 100).alias("error_rate_pct"),
    )


def _rule_rank(column: Column) -> Column:
    return F.array_position(F.array(*[F.lit(r) for r in REASONS]), column)


def error_listing(
    errors: DataFrame,
    error_type: str | None = None,
    limit: int = 100,
    tie_break: list[str] | None = None,
) -> DataFrame:
    """The first ``limit`` errors in rule order, each with the total and shown counts.

    ``error_type`` is matched exactly after upper-casing; empty means all.
    """
    if not 1 <= limit <= 1000:
        raise ValueError("limit must be within 1..1000")
    chosen = (
        errors.filter(F.col("error_reason") == error_type.upper()) if error_type else errors
    )
    count = chosen.agg(F.count(F.lit(1)).alias("total")).scalar()
    order = [_rule_rank(F.col("error_reason")), F.col("log_id"), *(tie_break or [])]
    rest = [c for c in errors.columns if c not in ("log_id", *(tie_break or []))]
    return (
        chosen.orderBy(*order, *rest)
        .limit(limit)
        .withColumn("total", count)
        .withColumn("showing", F.least(F.col("total"), F.lit(limit).cast("bigint")))
    )


def error_summary(errors: DataFrame) -> DataFrame:
    """Count and percentage per reason, most frequent first; no rows without errors."""
    counts = errors.groupBy(
        F.coalesce("error_reason", F.lit("UNKNOWN")).alias("error_reason")
    ).agg(F.count(F.lit(1)).alias("count"))
    everything = F.sum("count").over(Window.partitionBy())
    return counts.select(
        "error_reason",
        "count",
        ratio(F.col("count").cast(COUNT), everything.cast(COUNT), 2, 100).alias("percentage"),
        everything.alias("total_errors"),
    ).orderBy(F.desc("count"), _rule_rank(F.col("error_reason")), "error_reason")

"""Merges of a load into a table, as DataFrame in, DataFrame out.

The sinks decide what of a table is read and rewritten; these functions only say
what the rows are afterwards.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from shiftpay import schemas
from shiftpay.functions.firsts import mark_repeats
from shiftpay.operators.pay import NO_DEPARTMENT, folded, folded_list, joined_parts

# Columns an update overwrites; the others keep their first value.
EMPLOYEE_UPDATES = ["department", "pay_rate", "status", "email"]
EMPLOYEE_KEEPS = ["first_name", "last_name", "hire_date"]
PAYROLL_UPDATES = ["total_hours", "total_overtime", "total_gross_pay", "num_shifts"]
PAYROLL_KEEPS = ["department", "pay_period"]


def _pick(first: str, second: str, column: str) -> Column:
    """``column`` of side ``first`` where that side has a row, else of ``second``."""
    return F.when(F.col(f"{first}._row"), F.col(f"{first}.{column}")).otherwise(
        F.col(f"{second}.{column}")
    )


def _matched(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    here = F.lit(True).alias("_row")
    return (
        old.select("*", here)
        .alias("old")
        .join(new.select("*", here).alias("new"), keys, "full")
    )


def latest_employees(source: DataFrame, order_by: list[str]) -> DataFrame:
    """One row per employee: kept columns of the first row, updated ones of the last."""
    position = F.struct(*order_by)
    first = F.min_by(F.struct(*EMPLOYEE_KEEPS), position)
    last = F.max_by(F.struct(*EMPLOYEE_UPDATES), position)
    return (
        source.groupBy("employee_id")
        .agg(first.alias("_first"), last.alias("_last"))
        .select("employee_id", "_first.*", "_last.*")
    )


def upsert_employees(
    old: DataFrame, source: DataFrame, now: datetime, order_by: list[str] | None = None
) -> DataFrame:
    """The directory after loading ``source``.

    ``order_by`` gives the row order of a source that may repeat an employee.
    """
    new = latest_employees(source, order_by) if order_by else source
    new = new.withColumn("department", F.coalesce("department", F.lit(NO_DEPARTMENT)))
    time = F.lit(now).cast("timestamp")
    known, loaded = F.col("old._row"), F.col("new._row")
    columns = {c: _pick("old", "new", c) for c in EMPLOYEE_KEEPS}
    columns |= {c: _pick("new", "old", c) for c in EMPLOYEE_UPDATES}
    columns["created_at"] = F.when(known, F.col("old.created_at")).otherwise(time)
    columns["updated_at"] = F.when(loaded, time).otherwise(F.col("old.updated_at"))
    return _matched(old, new, ["employee_id"]).select(
        "employee_id",
        *[columns[c].alias(c) for c in schemas.names(schemas.EMPLOYEE_TABLE)[1:]],
    )


def absent_logs(
    old: DataFrame, new: DataFrame, order_by: list[str] | None = None
) -> DataFrame:
    """The rows of ``new`` to insert: log_id not in ``old``, and its first row in ``new``.

    Without ``order_by`` the ids of ``new`` are taken to be unique, as validation
    leaves them.
    """
    return without_ids(first_logs(new, order_by), old)


def first_logs(new: DataFrame, order_by: list[str] | None) -> DataFrame:
    """The first row of each log_id; without ``order_by`` they are unique already."""
    if not order_by:
        return new
    return mark_repeats(new, "log_id", order_by, "_again").filter("not _again").drop("_again")


def known_ids(old: DataFrame, new: DataFrame) -> DataFrame:
    """The ids (log_id) of ``old`` that ``new`` has too."""
    ids = new.select("log_id").alias("i")
    same = F.col("o.log_id").eqNullSafe(F.col("i.log_id"))
    return old.select("log_id").alias("o").join(ids, same, "left_semi")


def without_ids(rows: DataFrame, known: DataFrame) -> DataFrame:
    """The rows whose id is not in ``known`` (log_id), where no id counts as one.

    Ids are compared as they are, so rows that lie by id, as validation leaves them, stay where
    they are; rows without one are asked for apart, of which one row of ``known`` tells.
    """
    ids = known.select(F.col("log_id").alias("_known"))
    absent = rows.join(ids, F.col("log_id") == F.col("_known"), "left_anti")
    none = F.col("_known").isNull()
    no_id = F.broadcast(ids.filter(none).limit(1).select(none.alias("_none")))
    return absent.join(no_id, F.col("log_id").isNull() == F.col("_none"), "left_anti")


def upsert_payroll(old: DataFrame, summary: DataFrame) -> DataFrame:
    """Payroll rows after loading ``summary``, folded to one row per employee and week.

    Where both sides have ``created_at``, as stored rows do, a known row keeps its own; where
    both have ``parts``, those of the load count.
    """
    columns = {c: _pick("old", "new", c) for c in PAYROLL_KEEPS}
    columns |= {c: _pick("new", "old", c) for c in PAYROLL_UPDATES}
    columns["created_at"] = _pick("old", "new", "created_at")
    columns["parts"] = _pick("new", "old", "parts")
    columns["loaded"] = F.col("new._row").isNotNull()
    both = {*old.columns} & {*summary.columns}
    names = [c for c in schemas.names(schemas.PAYROLL_FILE) if c in both]
    keys = ["employee_id", "week_start"]
    if "parts" in both:
        names.append("loaded")
    return _matched(old, summary, keys).select(*keys, *[columns[c].alias(c) for c in names[2:]])


def _met(old: DataFrame, new: DataFrame, row: str) -> DataFrame:
    """Stored payroll rows (``_old``) and loaded ones (struct ``row``) in one frame, each null on the
    other's rows, dealt by ranges of weeks and employees: the rows of a key lie together.

    One shuffle so serves the merge and the order of the payroll files. Rows of a key are a few
    at most. Stored rows without an employee or a week meet no others, as in a join.
    """
    keys = ["employee_id", "week_start"]
    kept = [c for c in old.columns if c not in keys]
    no_key = F.col("employee_id").isNull() | F.col("week_start").isNull()
    stored = old.select(
        *keys,
        F.struct(*kept).alias("_old"),
        F.when(no_key, F.monotonically_increasing_id()).alias("_apart"),
    )
    loaded = new.select(*keys, F.struct(*[c for c in new.columns if c not in keys]).alias(row))
    both = stored.unionByName(loaded, allowMissingColumns=True)
    return both.repartitionByRange("week_start", "employee_id")


def add_payroll(old: DataFrame, parts: DataFrame, now: datetime) -> DataFrame:
    """Payroll rows after adding the ``parts`` of more shifts, by ranges of weeks and employees.

    A row is rounded anew from all its parts if it gets some; ``loaded`` says so. Stored rows
    come along in whole, so one shuffle adds to some and keeps the others.
    """
    keys = ["employee_id", "week_start"]
    kept = [*PAYROLL_KEEPS, *PAYROLL_UPDATES, "created_at"]
    parts = parts.select(*keys, *schemas.names(schemas.PAYROLL_PART))
    rows = _met(old, parts, "_part").groupBy(*keys, "_apart").agg(
        F.collect_list("_part").alias("_parts"), F.first("_old", ignorenulls=True).alias("_old")
    )
    known, loaded = F.col("_old").isNotNull(), F.size("_parts") > 0
    rows = rows.select(
        *keys,
        F.when(loaded & known, joined_parts(F.col("_old.parts"), F.col("_parts")))
        .otherwise(F.when(loaded, F.col("_parts")).otherwise(F.col("_old.parts")))
        .alias("parts"),
        loaded.alias("loaded"),
        "_old",
    )
    rows = rows.select("*", *folded_list("parts"), F.lit(now).cast("timestamp").alias("created_at"))
    columns = {c: F.when(known, F.col(f"_old.{c}")).otherwise(F.col(c)) for c in kept}
    columns |= {
        c: F.when(F.col("loaded"), F.col(c)).otherwise(F.col(f"_old.{c}")) for c in PAYROLL_UPDATES
    }
    names = schemas.names(schemas.PAYROLL_FILE)
    return rows.select(*[columns.get(c, F.col(c)).alias(c) for c in names], "loaded")


def fold_into_payroll(old: DataFrame, summary: DataFrame, now: datetime) -> DataFrame:
    """Payroll rows (``old``) after loading a summary, as if by ``upsert_payroll`` once it is folded to
    rows without parts; by ranges of weeks and employees, with ``loaded``."""
    keys = ["employee_id", "week_start"]
    summary = summary.select(*keys, *PAYROLL_KEEPS, *PAYROLL_UPDATES)
    # weeks first: the order that the rows are added up in is that of the payroll files
    rows = _met(old, summary, "_row").groupBy("week_start", "employee_id", "_apart").agg(
        *folded("_row"),
        (F.count("_row") > 0).alias("loaded"),
        F.first("_old", ignorenulls=True).alias("_old"),
    )
    known, loaded = F.col("_old").isNotNull(), F.col("loaded")
    time = F.lit(now).cast("timestamp")
    columns = {c: F.when(known, F.col(f"_old.{c}")).otherwise(F.col(c)) for c in PAYROLL_KEEPS}
    columns |= {c: F.when(loaded, F.col(c)).otherwise(F.col(f"_old.{c}")) for c in PAYROLL_UPDATES}
    columns["created_at"] = F.when(known, F.col("_old.created_at")).otherwise(time)
    columns["parts"] = F.when(~loaded, F.col("_old.parts"))
    names = schemas.names(schemas.PAYROLL_FILE)
    return rows.select(*[columns.get(c, F.col(c)).alias(c) for c in names], "loaded")

"""What loads move: rows once by id, payroll once by ranges of weeks, copies of stored shifts not at all."""

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from shiftpay import schemas
from shiftpay.functions.firsts import mark_repeats
from shiftpay.operators import merge, pay
from shiftpay.plans import registry
from shiftpay.plans.pipeline import run_pipeline
from shiftpay.sources import files, sinks
from rows import logs, raw, staff

NOW, LATER = datetime(2024, 2, 1), datetime(2024, 2, 2)


def _plan(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()


def _shifts(spark, first: int, count: int):
    """Shifts of employees in some weeks and departments, one in five without a date."""
    start = datetime(2024, 1, 1, 8)
    return logs(
        spark,
        *[
            {
                "log_id": f"L{n}",
                "employee_id": f"E{n % 4}",
                "department": "ABC"[n % 3],
                "clock_in": start.replace(day=1 + n % 20),
                "seconds": 20000 + 777 * n,
                "log_date": None if n % 5 == 0 else date(2024, 1, 1 + n % 20),
            }
            for n in range(first, first + count)
        ],
    )


def _stored(spark, shifts):
    """Payroll rows as a load leaves them."""
    lists = pay.part_lists(pay.payroll_parts(shifts))
    columns = [*pay.folded_list("parts"), "parts", F.lit(NOW).cast("timestamp").alias("created_at")]
    rows = lists.select("employee_id", "week_start", *columns)
    return rows.select(*schemas.names(schemas.PAYROLL_FILE)).localCheckpoint()


def test_the_hash_of_an_id_is_not_moved(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "log_id string, n int")
    earlier = spark.createDataFrame([("b",)], "log_id string")
    for marked in (
        mark_repeats(rows, "log_id", ["n"], "again"),
        mark_repeats(rows, "log_id", ["n"], "again", earlier),
    ):
        lines = [x for x in _plan(marked).splitlines() if "Exchange" in x]
        assert len(lines) == 1 and "hashpartitioning(log_id#" in lines[0]


def test_rows_that_lie_by_id_stay_to_look_up_known_ids(spark):
    ids = [("a",), ("a",), ("b",), (None,)]
    rows = spark.createDataFrame(ids, "log_id string").repartition("log_id")
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        for known, left in (
            ([("a",)], ["b", None]),
            ([("a",), (None,), (None,)], ["b"]),
            ([], ["a", "a", "b", None]),
            ([(None,)], ["a", "a", "b"]),
        ):
            old = spark.createDataFrame(known, "log_id string").repartition("log_id")
            absent = merge.without_ids(rows, old)
            assert "hashpartitioning(coalesce" not in _plan(absent)
            assert sorted([r.log_id for r in absent.collect()], key=str) == sorted(left, key=str)
    finally:
        spark.conf.set(setting, before)


def test_processed_tables_move_and_stage_what_is_used(spark, monkeypatch):
    staged, dealt, stage, write = [], [], files.stage, sinks.write_logs

    def noted_stage(rows, *more):
        staged.append(rows.columns)
        return stage(rows, *more)

    def noted_write(rows, *more, **named):
        dealt.append(rows.columns)
        return write(rows, *more, **named)

    monkeypatch.setattr(files, "stage", noted_stage)
    monkeypatch.setattr(sinks, "write_logs", noted_write)
    found = registry.queries()["processed_tables"](spark, "/root/testdata/sf0.001")
    assert {r.table_name: r.row_count for r in found.collect()}["payroll_summary"] > 0
    raw_columns = schemas.names(schemas.RAW_LOGS)
    assert staged == [[*raw_columns, "error_reason"]] and dealt == [raw_columns]


def test_payroll_is_moved_once_and_lies_by_week(spark):
    old, parts = _stored(spark, _shifts(spark, 0, 40)), pay.payroll_parts(_shifts(spark, 40, 40))
    parts = parts.localCheckpoint()
    summary = pay.summary_of_parts(parts)
    for merged in (merge.add_payroll(old, parts, LATER), merge.fold_into_payroll(old, summary, LATER)):
        found = _plan(merged)
        assert found.count("Exchange rangepartitioning(week_start") == found.count("Exchange") == 1


def test_payroll_with_parts_added_equals_payroll_of_all_shifts(spark):
    dated = F.col("log_date").isNotNull()
    first, second = _shifts(spark, 0, 40).filter(dated), _shifts(spark, 40, 40).filter(dated)
    merged = merge.add_payroll(_stored(spark, first), pay.payroll_parts(second), LATER)
    sums = ["employee_id", "week_start", "num_shifts", "total_hours", "total_gross_pay"]
    whole = pay.fold_payroll(pay.payroll_summary(first.unionByName(second)))
    assertDataFrameEqual(merged.select(*sums), whole.select(*sums))


def test_stored_rows_that_get_nothing_or_have_no_week_stay(spark):
    old = _stored(spark, _shifts(spark, 0, 40))
    one = logs(spark, {"log_id": "X", "employee_id": "E1", "log_date": None})
    merged = merge.add_payroll(old, pay.payroll_parts(one), LATER)
    names = schemas.names(schemas.PAYROLL_FILE)
    assertDataFrameEqual(merged.filter("not loaded").select(*names), old)
    (new,) = merged.filter("loaded").collect()
    assert (new.employee_id, new.week_start, new.num_shifts) == ("E1", None, 1)
    assert new.total_hours == Decimal("8.00")


def test_folding_into_payroll_equals_fold_and_upsert(spark):
    old = _stored(spark, _shifts(spark, 0, 40))
    summary = pay.payroll_summary(_shifts(spark, 30, 40)).localCheckpoint()
    merged = merge.fold_into_payroll(old, summary, LATER)
    unknown = F.lit(None).cast(schemas.PAYROLL_FILE["parts"].dataType)
    time = F.lit(LATER).cast("timestamp")
    folded = pay.fold_payroll(summary).withColumns({"parts": unknown, "created_at": time})
    assertDataFrameEqual(merged.select(*old.columns, "loaded"), merge.upsert_payroll(old, folded))


def test_stored_shifts_are_not_dealt_again_for_the_warehouse(spark, tmp_path, monkeypatch):
    plans, write = [], sinks.write_logs

    def noted(rows, path, finish=None, by_month=False):
        plans.append(path.startswith(str(tmp_path / "w")) and by_month)
        return write(rows, path, finish, by_month)

    monkeypatch.setattr(sinks, "write_logs", noted)
    root, warehouse = str(tmp_path / "t"), str(tmp_path / "w")
    for day in (3, 30):
        shifts = raw(spark, *[{"log_id": f"L{day}-{n}", "clock_in": datetime(2024, 1 + n, day % 28, 8)} for n in range(3)])
        run_pipeline(spark, root, staff(spark, {}), shifts, ["n"], ["employee_id"], warehouse=warehouse).collect()
    assert plans == [False, True, False, True]
    tables = [sinks.time_logs(spark, folder) for folder in (root, warehouse)]
    assert tables[1].count() == 6
    assertDataFrameEqual(*tables)


def test_loaded_files_are_compressed_by_zstd(spark, tmp_path):
    sinks.load_time_logs(str(tmp_path), logs(spark, {}), 1)
    assert [str(p) for p in tmp_path.rglob("*.zstd.parquet")]

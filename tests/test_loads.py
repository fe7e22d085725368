from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from rows import by, logs, raw, staff
from shiftpay import schemas
from shiftpay.operators import merge, pay, quality
from shiftpay.plans.load import load_raw
from shiftpay.plans import load
from shiftpay.plans.pipeline import run_pipeline
from shiftpay.sources import files, readers, sinks
from shiftpay.streaming import incremental

NOW = datetime(2024, 2, 1, tzinfo=timezone.utc)
LATER = datetime(2024, 3, 1, tzinfo=timezone.utc)
HEADER = "log_id,employee_id,clock_in,clock_out,department,pay_rate,log_date\n"


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "tables")


# --- readers -----------------------------------------------------------------


def test_time_log_csv(spark, tmp_path):
    path = tmp_path / "logs.csv"
    path.write_text(
        HEADER
        + "L1,E1,2024-01-03 08:00:00,2024-01-03 16:00:00,NA,20.50,2024-01-03\n"
        + "L2,,2024-01-03 08:00:00,,A,20.50,2024-01-03\n"
        + 'L3,"",2024-01-03 08:00:00,garbage,A,much,2024-01-03\n'
        + "NULL,E1,soon,2024-01-03 16:00:00,A,20.50,2024-01-03\n"
    )
    found = {r._line: r for r in readers.read_time_logs(spark, str(path)).collect()}
    rows = [found[k] for k in sorted(found)]
    assert [r.log_id for r in rows] == ["L1", "L2", "L3", None]
    assert [r.employee_id for r in rows] == ["E1", None, None, "E1"]
    assert [r.clock_out is None for r in rows] == [False, True, True, False]
    assert [r.department for r in rows] == [None, "A", "A", "A"]
    assert [r.pay_rate for r in rows] == [Decimal("20.50"), Decimal("20.50"), None, Decimal("20.50")]
    assert rows[0].clock_in == datetime(2024, 1, 3, 8) and rows[3].clock_in is None
    kept = readers.read_time_logs(spark, str(path), null_tokens=("",))
    assert by(kept, "log_id", "department")["L1"] == "NA"


def test_file_order_decides_the_first_row(spark, tmp_path):
    for name, rate in (("b", "2.00"), ("a", "1.00")):
        lines = [f"X,E1,2024-01-03 08:00:00,2024-01-03 16:00:00,A,{rate},2024-01-03"]
        lines += [line.replace(rate, "9.00") for line in lines]
        (tmp_path / f"{name}.csv").write_text(HEADER + "\n".join(lines) + "\n")
    rows = readers.read_time_logs(spark, str(tmp_path))
    validated = quality.validate(rows, readers.FILE_ORDER)
    assert [r.pay_rate for r in quality.clean_logs(validated).collect()] == [Decimal("1.00")]


def test_wrong_header_and_missing_file_raise(spark, tmp_path):
    with pytest.raises(AnalysisException):
        readers.read_employees(spark, str(tmp_path / "none.csv"))
    (tmp_path / "x.csv").write_text("id,name\n1,A\n")
    with pytest.raises(Exception):
        readers.read_employees(spark, str(tmp_path / "x.csv")).collect()


def test_absent_table_is_empty(spark, root):
    assert sinks.validation_errors(spark, root).count() == 0
    assert sinks.employees(spark, root).schema == schemas.EMPLOYEE_TABLE


def test_csv_round_trip(spark, tmp_path):
    shifts = logs(spark, {}, {"department": None, "seconds": 9 * 3600})
    path = str(tmp_path / "out")
    sinks.write_csv(shifts, path)
    assertDataFrameEqual(readers.read_processed(spark, path, schemas.TIME_LOGS), shifts)


# --- merges ------------------------------------------------------------------


def test_employee_upsert(spark, root):
    first = staff(spark, {}, {"department": None})
    assert sinks.load_employees(root, first, NOW) == 2
    assert by(sinks.employees(spark, root), "employee_id", "department")["E2"] == "UNKNOWN"

    change = {"first_name": "Bob", "pay_rate": Decimal("30.00"), "department": "Z"}
    again = staff(spark, change, {"employee_id": "E3"})
    assert sinks.load_employees(root, again, LATER) == 2  # of three
    found = {r.employee_id: r for r in sinks.employees(spark, root).collect()}
    one = found["E1"]
    assert (one.first_name, one.pay_rate, one.department) == ("Ann", Decimal("30.00"), "Z")
    assert (one.created_at, one.updated_at) == (
        datetime(2024, 2, 1), datetime(2024, 3, 1),
    )
    assert found["E2"].updated_at == datetime(2024, 2, 1)
    assert found["E3"].created_at == datetime(2024, 3, 1)


def test_repeated_employee_keeps_first_names_and_last_values(spark):
    source = staff(
        spark,
        {"employee_id": "E1", "first_name": "Ann", "pay_rate": Decimal("1.00")},
        {"employee_id": "E1", "first_name": "Bob", "pay_rate": Decimal("2.00")},
    ).withColumn("_line", F.when(F.col("first_name") == "Ann", 1).otherwise(2))
    none = spark.createDataFrame([], schemas.EMPLOYEE_TABLE)
    row = merge.upsert_employees(none, source, NOW, ["_line"]).first()
    assert (row.first_name, row.pay_rate) == ("Ann", Decimal("2.00"))


def test_unfinished_version_is_not_read(spark, root):
    sinks.load_employees(root, staff(spark, {}), NOW)
    staff(spark, {}, {}).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(f"{root}/employees/version=2")
    assert sinks.employees(spark, root).count() == 1


def test_absent_logs(spark):
    old = logs(spark, {"log_id": "A"}, {"log_id": None})
    new = raw(spark, {"log_id": "A"}, {"log_id": "B"}, {"log_id": "B"}, {"log_id": None})
    found = merge.absent_logs(old, new, ["n"]).collect()
    assert [(r.log_id, r.n) for r in found] == [("B", 1)]


def test_payroll_upsert_keeps_the_department(spark, root):
    first = pay.payroll_summary(logs(spark, {"department": "A"}))
    assert sinks.load_payroll(root, first, NOW) == 1
    other_week = {"clock_in": datetime(2024, 6, 3, 8)}
    second = pay.payroll_summary(
        logs(spark, {"department": "B", "seconds": 9 * 3600}, other_week)
    )
    assert sinks.load_payroll(root, second, LATER) == 2
    found = {r.week_start: r for r in sinks.payroll(spark, root).collect()}
    assert found[date(2024, 1, 1)].department == "A"
    assert found[date(2024, 1, 1)].total_overtime == Decimal("1.00")
    assert [found[d].created_at.month for d in sorted(found)] == [2, 3]
    assert set(found) == {date(2024, 1, 1), date(2024, 6, 3)}


# --- uploads -----------------------------------------------------------------


def test_upload_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.sql("select 1 as a, timestamp'2024-01-01 00:00:00' as t")
    assert sinks.upload(rows, path, sinks.EMPTY) == 1
    assert dict(spark.read.parquet(path).dtypes)["t"] == "timestamp_ntz"
    with pytest.raises(ValueError):
        sinks.upload(rows, path, sinks.EMPTY)
    sinks.upload(rows, path, sinks.APPEND)
    assert spark.read.parquet(path).count() == 2
    sinks.upload(rows, path, sinks.TRUNCATE)
    assert spark.read.parquet(path).count() == 1
    sinks.upload(rows.filter("false"), path, sinks.TRUNCATE)
    assert sinks.upload(rows, path, sinks.EMPTY) == 1
    with pytest.raises(ValueError):
        sinks.upload(rows, path, "WRITE_SOMEHOW")


def test_upload_records_a_failure(spark, root):
    shifts = logs(spark, {})
    broken = sinks.upload_all(root, shifts.drop("gross_pay"), pay.payroll_summary(shifts), staff(spark, {}), 1, NOW)
    assert broken.rows == {"employees": 1} and "gross_pay" in broken.problem
    assert broken.problem.startswith("time_logs") and not files.exists(spark, f"{root}/payroll_summary")


# --- whole runs ----------------------------------------------------------------


def _raw(spark):
    """Two loads: a late shift of an old week, repeats of a clean and of a flagged id."""
    return raw(
        spark,
        {"log_id": "A"},
        {"log_id": "B", "clock_out": None},
        {"log_id": "C", "clock_in": datetime(2024, 1, 31, 8), "department": None},
        {"log_id": "A"},
        {"log_id": None},
        {"log_id": "D", "clock_in": datetime(2024, 1, 4, 8), "seconds": 10 * 3600},
        {"log_id": "B"},
        {"log_id": "A"},
        {"log_id": None},
        {"log_id": "E", "clock_in": datetime(2024, 2, 1, 8), "employee_id": "E2"},
        {"log_id": "F", "clock_in": datetime(2024, 2, 1, 8), "seconds": 60},
    )


def _tables(spark, root):
    return {
        "logs": sinks.time_logs(spark, root).select(schemas.names(schemas.TIME_LOGS)),
        "errors": sinks.validation_errors(spark, root).select(
            *schemas.names(schemas.RAW_LOGS), "error_reason"
        ),
        "payroll": sinks.payroll(spark, root).drop("created_at"),
    }


def _same(left, right):
    for name in left:
        assertDataFrameEqual(left[name], right[name].select(left[name].columns))


def test_two_loads_equal_one(spark, tmp_path):
    rows = _raw(spark)
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    load_raw(one, rows, ["n"], 0, "r", NOW)
    load_raw(two, rows.filter("n < 5"), ["n"], 0, "r0", NOW)
    before = {k: v.collect() for k, v in _tables(spark, two).items()}
    second = load_raw(two, rows.filter("n >= 5"), ["n"], 1, "r1", NOW)
    assert (second.logs_inserted, second.has_errors) == (2, True)
    _same(_tables(spark, one), _tables(spark, two))
    assert len(before["logs"]) == 3 and sinks.time_logs(spark, two).count() == 5

    # A load replayed, as after a failure, changes nothing.
    load_raw(two, rows.filter("n >= 5"), ["n"], 1, "r1", NOW)
    _same(_tables(spark, one), _tables(spark, two))
    # The same rows as a new load insert nothing and are all duplicates.
    third = load_raw(two, rows.filter("n >= 5"), ["n"], 2, "r2", NOW)
    assert third.logs_inserted == 0
    assertDataFrameEqual(_tables(spark, one)["payroll"], _tables(spark, two)["payroll"])
    assert sinks.validation_errors(spark, two).filter(
        "batch_id = 2 and error_reason = 'DUPLICATE_RECORD'"
    ).count() == 6


def test_no_error_file_without_errors(spark, root):
    load = load_raw(root, raw(spark, {}), ["n"], 0, "r", NOW)
    assert not load.has_errors
    assert not files.exists(spark, f"{root}/validation_errors")


def test_pipeline(spark, tmp_path):
    root, warehouse = str(tmp_path / "t"), str(tmp_path / "w")
    people = staff(spark, {}, {})
    row = run_pipeline(
        spark, root, people, _raw(spark), ["n"], ["employee_id"], csv_export=True, warehouse=warehouse
    ).first()
    assert (row.status, row.upload.status, row.batch_id) == ("SUCCESS", "success", 1)
    assert (row.validate.records_in, row.validate.clean_records) == (11, 5)
    assert row.transform.transformed_logs == 5
    assert (row.load.employees, row.load.time_logs, row.load.payroll_summary) == (2, 5, 3)
    assert sinks.payroll(spark, warehouse).count() == 3
    assert spark.read.option("header", True).csv(f"{root}/export/time_logs").count() == 5
    assert sinks.next_batch(spark, root) == 2

    again = run_pipeline(spark, root, people, _raw(spark), ["n"], ["employee_id"]).first()
    assert (again.batch_id, again.load.time_logs, again.upload.status) == (2, 0, "skipped")
    assert sinks.time_logs(spark, root).count() == 5


def test_a_run_that_broke_off_is_made_good_by_the_next(spark, tmp_path, monkeypatch):
    whole, broken = str(tmp_path / "whole"), str(tmp_path / "broken")
    people = staff(spark, {}, {})
    run_pipeline(spark, whole, people, _raw(spark), ["n"], ["employee_id"])

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(load.sinks, "write_payroll", fail)
        with pytest.raises(RuntimeError):
            run_pipeline(spark, broken, people, _raw(spark), ["n"], ["employee_id"])
    assert sinks.time_logs(spark, broken).count() == 0  # nothing shows before all of it does
    again = run_pipeline(spark, broken, people, _raw(spark), ["n"], ["employee_id"]).first()
    assert (again.batch_id, again.load.time_logs) == (1, 5)
    _same(_tables(spark, whole), _tables(spark, broken))


def test_stream_equals_batch_and_restarts(spark, tmp_path):
    text = _raw(spark).withColumns(
        {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("clock_in", "clock_out")}
    )
    rows = [
        ",".join("" if r[c] is None else str(r[c]) for c in schemas.names(schemas.RAW_LOGS))
        for r in text.orderBy("n").collect()
    ]
    source = tmp_path / "raw"
    source.mkdir()
    root, checkpoint = str(tmp_path / "stream"), str(tmp_path / "checkpoint")

    def run():
        stream = incremental.raw_file_stream(spark, str(source), files_per_batch=1)
        query = incremental.run_available(stream, root, checkpoint)
        query.awaitTermination()
        return query

    (source / "1.csv").write_text(HEADER + "\n".join(rows[:5]) + "\n")
    run()
    (source / "2.csv").write_text(HEADER + "\n".join(rows[5:]) + "\n")
    run()
    batch = str(tmp_path / "batch")
    load_raw(batch, _raw(spark), ["n"], 0, "r", NOW)
    _same(_tables(spark, batch), _tables(spark, root))
    assert run().lastProgress is None or run().lastProgress["numInputRows"] == 0
    _same(_tables(spark, batch), _tables(spark, root))


def _stored_ids(spark, root):
    return sorted(r.log_id for r in sinks.time_logs(spark, root).collect())


def _batch_and_stream_loads(spark, tmp_path):
    source, root = str(tmp_path / "raw"), str(tmp_path / "mixed")
    people, typed = staff(spark, {}, {}), raw(spark, {})
    run_pipeline(
        spark, root, people, raw(spark, {"log_id": "A1"}, {"log_id": "A2"}, {"log_id": "A3"}),
        ["n"], ["employee_id"],
    ).collect()

    def follow(checkpoint, *ids):
        if ids:
            raw(spark, *[{"log_id": i} for i in ids]).coalesce(1).write.mode("append").parquet(source)
        stream = incremental.table_stream(spark, source, typed.schema)
        incremental.run_available(stream, root, checkpoint, ["n"]).awaitTermination()

    return root, people, follow


def test_batch_runs_and_streams_share_a_folder(spark, tmp_path):
    root, people, follow = _batch_and_stream_loads(spark, tmp_path)
    first, second = str(tmp_path / "c1"), str(tmp_path / "c2")
    follow(first, "A1", "B2")
    assert _stored_ids(spark, root) == ["A1", "A2", "A3", "B2"]
    follow(first, "C1")
    assert _stored_ids(spark, root) == ["A1", "A2", "A3", "B2", "C1"]
    flagged = sinks.validation_errors(spark, root).count()
    follow(second)  # a new stream over the same files: nothing but duplicates
    assert _stored_ids(spark, root) == ["A1", "A2", "A3", "B2", "C1"]
    assert sinks.validation_errors(spark, root).count() == flagged + 3
    assert sinks.run_errors(spark, root).count() == 3
    run_pipeline(spark, root, people, raw(spark, {"log_id": "D1"}), ["n"], ["employee_id"]).collect()
    assert _stored_ids(spark, root) == ["A1", "A2", "A3", "B2", "C1", "D1"]
    assert sinks.next_batch(spark, root) == 6


def test_a_finished_micro_batch_is_passed_over(spark, tmp_path, monkeypatch):
    root, _, follow = _batch_and_stream_loads(spark, tmp_path)
    follow(str(tmp_path / "c1"), "B1")
    name = spark.read.json(f"{tmp_path}/c1/metadata").first()["id"]
    assert sinks.was_loaded(spark, root, name, 0)
    assert not sinks.was_loaded(spark, root, name, 1)
    assert not sinks.was_loaded(spark, root, "another", 0)
    assert not sinks.was_loaded(spark, str(tmp_path / "nowhere"), name, 0)


def test_warehouse_weeks_hold_all_stored_shifts(spark, tmp_path):
    root, warehouse = str(tmp_path / "t"), str(tmp_path / "w")
    people = staff(spark, {}, {})
    days = [datetime(2024, 1, d, 8) for d in (1, 2)]
    for number, day in enumerate(days):
        shift = {"log_id": f"L{number}", "clock_in": day, "clock_out": day.replace(hour=16), "log_date": day.date()}
        row = run_pipeline(
            spark, root, people, raw(spark, shift), ["n"], ["employee_id"], warehouse=warehouse
        ).first()
        assert row.upload.status == "success" and row.duration_s.upload > 0
    weeks = [sinks.payroll(spark, folder).drop("created_at") for folder in (warehouse, root)]
    assertDataFrameEqual(*weeks)
    (week,) = sinks.payroll(spark, warehouse).collect()
    assert (week.num_shifts, float(week.total_hours)) == (2, 16.0)


def test_upload_of_the_stored_tables(spark, tmp_path):
    root, warehouse = str(tmp_path / "t"), str(tmp_path / "w")
    people = staff(spark, {}, {})
    for ids in (["A", "B"], ["C"]):
        shifts = raw(spark, *[{"log_id": i} for i in ids])
        run_pipeline(spark, root, people, shifts, ["n"], ["employee_id"]).collect()
    for _ in range(2):  # again changes nothing
        done = sinks.upload_stored(spark, root, warehouse, NOW)
        assert done.problem is None and done.rows["time_logs"] == 3
        assert _stored_ids(spark, warehouse) == ["A", "B", "C"]
        weeks = [sinks.payroll(spark, x).drop("created_at") for x in (warehouse, root)]
        assertDataFrameEqual(*weeks)
        assert spark.read.parquet(f"{warehouse}/employees").count() == 2


def test_a_run_over_a_growing_folder_flags_new_faults_only(spark, tmp_path):
    root, people = str(tmp_path / "t"), staff(spark, {}, {})
    rows = [{"log_id": "A"}, {"log_id": "B", "clock_out": None}, {"log_id": "C"}, {"log_id": "C"}]
    stored, flagged, last = [], [], []
    for n in (2, 3, 4, 4):
        run_pipeline(spark, root, people, raw(spark, *rows[:n]), ["n"], ["employee_id"]).collect()
        stored.append(sinks.time_logs(spark, root).count())
        flagged.append(sinks.validation_errors(spark, root).count())
        last.append(sinks.run_errors(spark, root).count())
    assert (stored, flagged, last) == ([1, 2, 2, 2], [1, 1, 1, 1], [1, 0, 0, 0])


def test_staged_files_are_deleted(spark, tmp_path):
    folder = files.scratch_folder(spark)
    before = set(files.folders(spark, folder))
    run_pipeline(
        spark, str(tmp_path / "t"), staff(spark, {}, {}), _raw(spark), ["n"], ["employee_id"],
        warehouse=str(tmp_path / "w"),
    ).collect()
    assert set(files.folders(spark, folder)) == before

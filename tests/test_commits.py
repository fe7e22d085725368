"""Loads that overlap, break off or are played again."""

import json
import threading
from datetime import datetime, timezone

import pytest
from pyspark.testing import assertDataFrameEqual

from rows import raw, staff
from shiftpay import schemas
from shiftpay.operators import pay
from shiftpay.plans import load as loads
from shiftpay.plans.load import load_raw
from shiftpay.sources import commits, files, sinks

NOW = datetime(2024, 2, 1, tzinfo=timezone.utc)


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "tables")


class Lost(Exception):
    pass


def _load(root, rows, run, **options):
    load = load_raw(root, rows, ["n"], None, run, NOW, **options)
    load.discard()
    return load


def _ids(spark, root):
    return sorted(r.log_id for r in sinks.time_logs(spark, root).collect())


def _assert_payroll_is_that_of_the_shifts(spark, root):
    shifts = sinks.time_logs(spark, root).select(*schemas.names(schemas.TIME_LOGS))
    expected = pay.fold_payroll(pay.payroll_summary(shifts)).drop("department")
    found = sinks.payroll(spark, root).drop("created_at", "department")
    assertDataFrameEqual(found, expected.select(*found.columns))


def _meanwhile(*steps):
    """Runs one step at each call, then nothing."""
    left = list(steps)
    return lambda: left.pop(0)() if left else None


def test_a_file_is_created_once(spark, tmp_path):
    path, made = str(tmp_path / "x" / "one"), []
    work = [
        threading.Thread(target=lambda k=k: made.append((files.create_new(spark, path, str(k)), k)))
        for k in range(8)
    ]
    for t in work:
        t.start()
    for t in work:
        t.join()
    (winner,) = [k for done, k in made if done]
    assert files.read_text(spark, path) == str(winner)
    assert files.names(spark, str(tmp_path / "x")) == ["one"]


def test_a_file_is_created_once_by_renaming(spark, tmp_path):
    jvm = spark.sparkContext._jvm
    source, target = (jvm.org.apache.hadoop.fs.Path(f"file://{tmp_path}/{n}") for n in "ab")
    for text in ("first", "second"):
        files.create_new(spark, f"file://{tmp_path}/{text}", text)
    (tmp_path / "first").rename(tmp_path / "a")
    files._rename_new(spark, source, target)
    (tmp_path / "second").rename(tmp_path / "a")
    with pytest.raises(Exception, match="exist"):
        files._rename_new(spark, source, target)
    assert (tmp_path / "b").read_text() == "first"


def test_state_survives_the_file(spark, root):
    state = commits.State(
        loads={3: {"run": "r"}}, logs={3: "a"}, ids={3: "a"}, weeks={"2024-01-01": "a"}, employees="e"
    )
    commits.commit(spark, root, commits.State(), lambda _: state, lambda _: False)
    found = commits.latest(spark, root)
    assert found == commits.State(1, *[getattr(state, k) for k in ("loads", "logs", "errors", "ids", "weeks", "employees")])
    assert found.next_load == 4
    stale = commits.commit(spark, root, commits.State(), lambda s: s, lambda _: False)
    assert stale is None and commits.latest(spark, root) == found


def test_overlapping_loads_keep_all_rows(spark, root):
    """Different ids in one week: both wrote the week, so the later one starts anew."""
    first, second = raw(spark, {"log_id": "A"}, {"log_id": "B"}), raw(spark, {"log_id": "C"})
    tries = []
    load = _load(
        root, first, "one",
        before_commit=lambda: (tries.append(1), _load(root, second, "two") if len(tries) == 1 else None),
    )
    assert (len(tries), load.number) == (2, 2)
    assert _ids(spark, root) == ["A", "B", "C"]
    assert sinks.payroll(spark, root).first().num_shifts == 3
    _assert_payroll_is_that_of_the_shifts(spark, root)


def _odd_shifts(spark, load):
    """Shifts of one week in two departments; hours and pay have more digits than totals."""
    return raw(
        spark,
        *[
            {"log_id": f"{load}-{k}", "department": f"D{k % 2}", "seconds": 8 * 3600 + 18 + 7 * k}
            for k in range(4)
        ],
    )


def test_payroll_goes_on_from_exact_sums_without_reading_shifts(spark, root, monkeypatch):
    def read(*_):
        raise AssertionError("stored shifts were read")

    _load(root, _odd_shifts(spark, "a"), "one")
    with monkeypatch.context() as patch:
        patch.setattr(loads.sinks, "time_logs", read)
        for name in "bcd":
            _load(root, _odd_shifts(spark, name), name)
    assert sinks.payroll(spark, root).first().num_shifts == 16
    assert sinks.payroll(spark, root).columns == schemas.names(schemas.PAYROLL_TABLE)
    _assert_payroll_is_that_of_the_shifts(spark, root)
    row = sinks.payroll(spark, root, with_parts=True).first()
    assert sorted((p.department, p.shifts) for p in row.parts) == [("D0", 8), ("D1", 8)]


def test_shifts_inserted_beside_loads_count(spark, root):
    _load(root, raw(spark, {"log_id": "A"}), "one")
    shifts = pay.transform(raw(spark, {"log_id": "B"})).select(*schemas.names(schemas.TIME_LOGS))
    assert sinks.load_time_logs(root, shifts, 5) == 1
    _load(root, raw(spark, {"log_id": "C"}), "two")
    _load(root, raw(spark, {"log_id": "D"}), "three")
    assert sinks.payroll(spark, root).first().num_shifts == 4
    _assert_payroll_is_that_of_the_shifts(spark, root)


def test_shifts_inserted_during_a_load_count(spark, root):
    shifts = pay.transform(raw(spark, {"log_id": "B"})).select(*schemas.names(schemas.TIME_LOGS))
    _load(root, raw(spark, {"log_id": "A"}), "one")
    tries = [lambda: sinks.load_time_logs(root, shifts, 9)]
    _load(root, raw(spark, {"log_id": "C"}), "two", before_commit=_meanwhile(*tries))
    assert sinks.payroll(spark, root).first().num_shifts == 3
    _assert_payroll_is_that_of_the_shifts(spark, root)


def test_payroll_written_beside_loads_is_made_good(spark, root):
    """Rows that came without shifts have no parts to go on from."""
    _load(root, raw(spark, {"log_id": "A"}), "one")
    sinks.load_payroll(root, sinks.payroll(spark, root).drop("created_at"), NOW)
    _load(root, raw(spark, {"log_id": "B"}), "two")
    assert sinks.payroll(spark, root).first().num_shifts == 2
    _assert_payroll_is_that_of_the_shifts(spark, root)


def test_tables_from_before_parts_go_on_from_shifts(spark, root):
    _load(root, raw(spark, {"log_id": "A"}), "one")
    (name,) = [n for n in files.names(spark, f"{root}/commits") if n.endswith(".json")]
    old = json.loads(files.read_text(spark, f"{root}/commits/{name}"))
    del old["loose"]
    files.create_new(spark, f"{root}/commits/{2:012d}.json", json.dumps(old | {"revision": 2}))
    assert commits.latest(spark, root).loose == 2
    _load(root, raw(spark, {"log_id": "B"}), "two")
    _assert_payroll_is_that_of_the_shifts(spark, root)


def test_a_load_that_nothing_met_only_gets_another_number(spark, root):
    march = {"clock_in": datetime(2024, 3, 5, 8), "log_date": datetime(2024, 3, 5).date()}
    march["clock_out"] = datetime(2024, 3, 5, 16)
    rows = raw(spark, {"log_id": "A"}, {"log_id": "B", "clock_out": None})
    tries = []
    load = _load(
        root, rows, "one",
        before_commit=lambda: (tries.append(1), _load(root, raw(spark, {"log_id": "C"} | march), "two")),
    )
    assert (len(tries), load.number) == (1, 2)
    stored = sinks.time_logs(spark, root).select("log_id", "batch_id").collect()
    assert sorted(map(tuple, stored)) == [("A", 2), ("C", 1)]
    assert [r.log_id for r in sinks.run_errors(spark, root).collect()] == ["B"]
    _assert_payroll_is_that_of_the_shifts(spark, root)


def test_an_id_that_two_overlapping_loads_hold_is_stored_once(spark, root):
    rows = raw(spark, {"log_id": "A"}, {"log_id": "B"})
    other = raw(spark, {"log_id": "A", "employee_id": "E9"})
    _load(root, rows, "one", before_commit=_meanwhile(lambda: _load(root, other, "two")))
    assert _ids(spark, root) == ["A", "B"]
    flagged = sinks.validation_errors(spark, root).select("log_id", "batch_id", "error_reason")
    assert [tuple(r) for r in flagged.collect()] == [("A", 2, "DUPLICATE_RECORD")]
    _assert_payroll_is_that_of_the_shifts(spark, root)


def test_loads_at_the_same_time(spark, root):
    """Real threads: whatever the order, every id is stored once and payroll fits."""
    failed = []

    def run(k):
        try:
            _load(root, raw(spark, {"log_id": "S"}, {"log_id": f"L{k}"}, {"log_id": f"M{k}"}), f"run {k}")
        except Exception as problem:
            failed.append(problem)

    work = [threading.Thread(target=run, args=(k,)) for k in range(3)]
    for t in work:
        t.start()
    for t in work:
        t.join()
    assert not failed
    assert _ids(spark, root) == ["L0", "L1", "L2", "M0", "M1", "M2", "S"]
    assert sorted(commits.latest(spark, root).loads) == [1, 2, 3]
    assert sinks.validation_errors(spark, root).count() == 2
    _assert_payroll_is_that_of_the_shifts(spark, root)


@pytest.mark.parametrize("step", ["write_logs", "load_errors", "write_ids", "write_payroll", "before_commit"])
def test_a_load_that_breaks_off_leaves_nothing_to_see(spark, root, monkeypatch, step):
    def lose(*_):
        raise Lost

    _load(root, raw(spark, {"log_id": "A"}), "one")
    before = [sinks.time_logs(spark, root).collect(), sinks.payroll(spark, root).collect()]
    scratch = set(files.names(spark, files.scratch_folder(spark)))
    rows = raw(spark, {"log_id": "B"}, {"log_id": "C", "clock_out": None})
    with monkeypatch.context() as patch, pytest.raises(Lost):
        if step != "before_commit":
            patch.setattr(loads.sinks, step, lose)
        _load(root, rows, "two", before_commit=lose)
    assert before == [sinks.time_logs(spark, root).collect(), sinks.payroll(spark, root).collect()]
    assert sinks.validation_errors(spark, root).count() == 0
    assert set(files.names(spark, files.scratch_folder(spark))) == scratch
    # another load, not the one that broke off, takes its place
    _load(root, raw(spark, {"log_id": "D"}), "three")
    _load(root, rows, "two")
    assert _ids(spark, root) == ["A", "B", "D"]
    _assert_payroll_is_that_of_the_shifts(spark, root)


def test_a_dead_driver_leaves_folders_that_clean_deletes(spark, root, monkeypatch):
    """Nobody tidies up behind a driver that dies."""
    _load(root, raw(spark, {"log_id": "A"}), "one")
    sinks.load_employees(root, staff(spark, {}), NOW)
    sinks.load_employees(root, staff(spark, {}, {}), NOW)
    with monkeypatch.context() as patch, pytest.raises(Lost):
        patch.setattr(loads, "_remove", lambda *_: None)
        _load(root, raw(spark, {"log_id": "B"}), "two", before_commit=lambda: (_ for _ in ()).throw(Lost))
    assert _ids(spark, root) == ["A"]
    assert commits.clean(spark, root, hours=1) == 0
    # three tables of the lost load, and the directory before the last
    assert commits.clean(spark, root, hours=-1) == 4
    assert _ids(spark, root) == ["A"] and sinks.employees(spark, root).count() == 2
    _assert_payroll_is_that_of_the_shifts(spark, root)
    assert commits.clean(spark, root, hours=-1) == 0


def test_directories_loaded_at_the_same_time(spark, root, monkeypatch):
    people = [staff(spark, {"employee_id": "E1"}), staff(spark, {"employee_id": "E2"})]
    write = sinks.write_table
    step = _meanwhile(lambda: sinks.load_employees(root, people[1], NOW))
    monkeypatch.setattr(sinks, "write_table", lambda *a: (write(*a), step()))
    sinks.load_employees(root, people[0], NOW)
    assert sorted(r.employee_id for r in sinks.employees(spark, root).collect()) == ["E1", "E2"]


def test_a_failing_replacement_leaves_the_old_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = spark.sql("select 1 as a union all select 2")
    sinks.upload(rows, path, sinks.TRUNCATE)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        sinks.upload(rows.selectExpr("1 / (a - 2) as a"), path, sinks.TRUNCATE)
    assert spark.read.parquet(path).count() == 2

    move = files.move
    monkeypatch.setattr(files, "move", lambda s, p, t: move(s, p, t) if "_new_" not in p else lose())

    def lose():
        raise OSError("lost")

    with pytest.raises(OSError):
        sinks.upload(rows.limit(1), path, sinks.TRUNCATE)
    assert spark.read.parquet(path).count() == 2
    monkeypatch.setattr(files, "move", move)
    # a driver that died between both renamings
    files.move(spark, path, files._aside(path))
    sinks.upload(rows, path, sinks.APPEND)
    assert spark.read.parquet(path).count() == 4
    assert files.names(spark, str(tmp_path)) == ["t"]


def test_a_load_in_the_way_costs_payroll_alone(spark, root, monkeypatch):
    """Both loads touch the same week and no common id: shifts are judged and written once."""
    judged = []
    validate = loads.quality.validate
    monkeypatch.setattr(loads.quality, "validate", lambda *a: (judged.append(1), validate(*a))[1])
    step = _meanwhile(lambda: _load(root, _odd_shifts(spark, "b"), "two"))
    _load(root, _odd_shifts(spark, "a"), "one", before_commit=step)
    assert len(judged) == 2
    assert sinks.payroll(spark, root).first().num_shifts == 8
    _assert_payroll_is_that_of_the_shifts(spark, root)


def test_staged_rows_of_a_load_hold_no_arrival_order(spark, root):
    load = _load(root, raw(spark, {"log_id": "A"}, {"log_id": "A"}), "one")
    assert load.validated.columns == [*schemas.names(schemas.RAW_LOGS), "error_reason"]

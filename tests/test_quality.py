from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rows import START, by, raw
from shiftpay.functions import firsts
from shiftpay.functions.firsts import mark_repeats
from shiftpay.operators import constraints, quality
from shiftpay.operators.quality import REASONS

NOW = datetime(2024, 2, 1)


def reasons(rows, **options):
    return by(quality.validate(rows, ["n"], **options), "n", "error_reason")


def test_first_rule_wins(spark):
    found = reasons(
        raw(
            spark,
            {"log_id": "X"},
            {"log_id": "X", "employee_id": None, "clock_out": None},
            {"employee_id": None, "clock_out": None},
            {"employee_id": ""},
            {"clock_out": None},
            {"clock_in": None},
            {"seconds": 0},
            {"seconds": -60},
        )
    )
    assert found == {
        0: None,
        1: "DUPLICATE_RECORD",
        2: "MISSING_EMPLOYEE_ID",
        3: "MISSING_EMPLOYEE_ID",
        4: "MISSING_CLOCK_OUT",
        5: "MISSING_CLOCK_IN",
        6: "INVALID_CLOCK_SEQUENCE",
        7: "INVALID_CLOCK_SEQUENCE",
    }


@pytest.mark.parametrize(
    "seconds, reason",
    [
        (1799, "INVALID_HOURS"),
        (1800, None),
        (86400, None),
        (86401, "INVALID_HOURS"),
        (1799.999999, "INVALID_HOURS"),
        (86400.000001, "INVALID_HOURS"),
    ],
)
def test_hour_bounds_are_inclusive(spark, seconds, reason):
    assert reasons(raw(spark, {"seconds": seconds})) == {0: reason}


def test_null_ids_form_one_group(spark):
    assert reasons(raw(spark, {"log_id": None}, {"log_id": None}, {"log_id": None})) == {
        0: None,
        1: "DUPLICATE_RECORD",
        2: "DUPLICATE_RECORD",
    }


def test_repeat_of_an_invalid_row_is_a_duplicate(spark):
    found = reasons(raw(spark, {"log_id": "X", "clock_out": None}, {"log_id": "X"}))
    assert found == {0: "MISSING_CLOCK_OUT", 1: "DUPLICATE_RECORD"}


def test_ids_seen_before_are_duplicates(spark):
    rows = raw(spark, {"log_id": "X"}, {"log_id": "Y"}, {"log_id": None})
    seen = spark.createDataFrame([("X",), (None,)], "log_id string")
    assert reasons(rows, seen=seen) == {
        0: "DUPLICATE_RECORD",
        1: None,
        2: "DUPLICATE_RECORD",
    }


@pytest.mark.parametrize("tasks", [1, 7])
def test_seen_ids_of_hot_keys(spark, tasks):
    rows = raw(spark, *[{"log_id": "X"}] * 30, *[{"log_id": "Y"}] * 30, {"log_id": None})
    seen = spark.createDataFrame([("X",), ("Z",)], "log_id string")
    found = quality.validate(rows.repartition(tasks), ["n"], seen)
    counts = Counter((r.log_id, r.error_reason) for r in found.collect())
    assert counts == {
        ("X", "DUPLICATE_RECORD"): 30,
        ("Y", None): 1,
        ("Y", "DUPLICATE_RECORD"): 29,
        (None, None): 1,
    }


@pytest.mark.parametrize("tasks", [1, 7])
def test_hot_ids_and_equal_rows(spark, tasks):
    same = {"log_id": "HOT", "n": 7}
    rows = raw(
        spark,
        *[{"log_id": "HOT", "n": 100 - i} for i in range(40)],
        *[same] * 5,
        *[{"log_id": None, "n": i} for i in range(30)],
        *[{"log_id": f"L{i}", "n": i} for i in range(20)],
        {"log_id": "L1", "n": 50},
    )
    found = quality.validate(rows.repartition(tasks), ["n"]).collect()
    assert len(found) == 96
    first = {(r.log_id, r.n) for r in found if r.error_reason is None}
    assert first == {("HOT", 7), (None, 0), *((f"L{i}", i) for i in range(20))}
    assert Counter(r.error_reason for r in found)["DUPLICATE_RECORD"] == 44 + 29 + 1


def test_no_task_gets_more_of_a_key_than_it_read(spark):
    rows = raw(spark, *[{"log_id": "HOT"}] * 700, *[{"log_id": f"L{i}"} for i in range(1400)])
    marked = mark_repeats(rows.repartition(50), "log_id", ["n"], "again")
    plan = marked._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.splitlines() if "windowspecdefinition" in x]
    assert len(windows) == 2 and "[_task" in windows[1]


def test_split_keeps_every_row(spark):
    validated = quality.validate(
        raw(spark, {}, {"clock_out": None}, {"seconds": 5}, {"department": None}), ["n"]
    )
    clean = quality.clean_logs(validated)
    errors = quality.validation_errors(validated, "run", NOW)
    assert clean.count() + errors.count() == 4
    assert {r.pipeline_run_id for r in errors.collect()} == {"run"}
    assert {r.flagged_at for r in errors.collect()} == {NOW}
    metrics = quality.run_metrics(validated).first()
    assert (metrics.records_in, metrics.clean_records, metrics.flagged_records) == (4, 2, 2)
    assert float(metrics.error_rate_pct) == 50.0


def test_metrics_of_no_rows(spark):
    empty = quality.validate(raw(spark, {}).filter("false"), ["n"])
    metrics = quality.run_metrics(empty).first()
    assert metrics.records_in == 0 and metrics.error_rate_pct is None


def _errors(spark):
    rows = [{"clock_out": None, "log_id": f"M{i}"} for i in range(3)]
    rows += [{"seconds": 5, "log_id": "H1"}, {"employee_id": None, "log_id": "E1"}]
    return quality.validation_errors(quality.validate(raw(spark, *rows), ["n"]), "run", NOW)


def test_error_listing(spark):
    errors = _errors(spark)
    everything = quality.error_listing(errors).collect()
    order = [REASONS.index(r.error_reason) for r in everything]
    assert order == sorted(order) and len(order) == 5
    some = quality.error_listing(errors, "missing_clock_out", 2).collect()
    assert [r.log_id for r in some] == ["M0", "M1"]
    assert {(r.total, r.showing) for r in some} == {(3, 2)}
    with pytest.raises(ValueError):
        quality.error_listing(errors, limit=0)
    with pytest.raises(ValueError):
        quality.error_listing(errors, limit=1001)


def test_error_summary(spark):
    errors = _errors(spark)
    found = [(r.error_reason, r["count"], float(r.percentage)) for r in quality.error_summary(errors).collect()]
    assert found == [
        ("MISSING_CLOCK_OUT", 3, 60.0),
        ("MISSING_EMPLOYEE_ID", 1, 20.0),
        ("INVALID_HOURS", 1, 20.0),
    ]
    assert quality.error_summary(errors.filter("false")).count() == 0
    unnamed = errors.withColumn("error_reason", F.lit(None).cast("string"))
    assert quality.error_summary(unnamed).first().error_reason == "UNKNOWN"


def test_constraint_audit(spark):
    rows = raw(
        spark,
        {"log_id": "X"},
        {"log_id": "X", "clock_out": START - timedelta(hours=1)},
        {"employee_id": None, "log_id": "L" * 13},
        {"log_id": None},
    )
    found = by(
        constraints.violated(constraints.audit(rows, "raw", constraints.RAW_LOGS)),
        "rule",
        "violations",
    )
    assert found == {
        "log_id_unique": 1,
        "clock_sequence": 1,
        "employee_id_required": 1,
        "log_id_length": 1,
        "log_id_required": 1,
    }


def test_constraint_audit_of_several_keys_reads_the_rows_once(spark):
    rows = spark.createDataFrame(
        [(1, "a", 1.0), (1, "b", 1.0), (2, "b", None), (2, "b", None), (None, "c", 2.0), (None, "c", 2.0)],
        "id long, name string, x double",
    )
    rules = constraints.Rules(required=("id",), unique=(("id",), ("name", "x"), ("name",)), checks={"small": "x < 2"})
    found = constraints.audit(rows, "t", rules)
    assert by(found, "rule", "violations") == {
        "id_required": 2, "small": 2, "id_unique": 2, "name_x_unique": 1, "name_unique": 2,
    }
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("LogicalRDD") + text.count("LocalRelation") == 1
    assert set(by(constraints.audit(rows.limit(0), "t", rules), "rule", "violations").values()) == {0}


def test_orphans(spark):
    rows = raw(spark, {"employee_id": "E1"}, {"employee_id": "E9"}, {"employee_id": None})
    staff = spark.createDataFrame([("E1",)], "employee_id string")
    assert [r.employee_id for r in constraints.orphans(rows, staff).collect()] == ["E9"]


@pytest.mark.parametrize("hot_rows", [5, 500])
@pytest.mark.parametrize("known_are_errors", [True, False])
def test_hot_and_other_ids_beside_ids_of_earlier_loads(spark, monkeypatch, hot_rows, known_are_errors):
    monkeypatch.setattr(firsts, "HOT_ROWS", hot_rows)
    rows = raw(
        spark,
        *[{"log_id": "X"}] * 30,
        *[{"log_id": "Y"}] * 30,
        *[{"log_id": None}] * 20,
        *[{"log_id": i} for i in ("A", "A", "B", "B")],
    )
    seen = spark.createDataFrame([("X",), ("A",), ("A",), ("Z",), (None,)], "log_id string")
    found = quality.validate(rows.repartition(7), ["n"], seen, known_are_errors)
    counts = Counter((r.log_id, r.error_reason) for r in found.collect())
    again = "DUPLICATE_RECORD"
    known = {("X", again): 30, (None, again): 20, ("A", again): 2} if known_are_errors else {}
    assert counts == {("Y", None): 1, ("Y", again): 29, ("B", None): 1, ("B", again): 1, **known}


def test_rows_move_once_to_the_others_of_their_id(spark):
    rows = raw(spark, *[{"log_id": f"L{i % 40}"} for i in range(60)])
    marked = mark_repeats(rows.repartition(5), "log_id", ["n"], "again")
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert marked.filter("again").count() == 20

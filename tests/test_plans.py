"""Plans as they would be with tables too large to broadcast."""

import re

import pytest

from shiftpay.plans import registry
from shiftpay.operators import reports
from shiftpay.sources import sinks
from rows import logs, staff

DATA = "/root/testdata/sf0.001"
# These run whole loads, and only read stored rows in the end.
LOADS = {
    "incremental_payroll", "mixed_loads", "warehouse_payroll", "warehouse_tables", "rerun_errors",
    "upload_modes", "processed_tables", "overlapping_loads",
}
NAMES = sorted(set(registry.queries()) - LOADS)


def plan(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


@pytest.mark.parametrize("name", NAMES)
def test_no_product_and_no_python(spark, no_broadcast, name):
    text = plan(registry.queries()[name](spark, DATA))
    for operator in ("CartesianProduct", "NestedLoopJoin", "Python", "Pandas"):
        assert operator not in text


def test_hours_report_joins_sums_not_shifts(spark, no_broadcast):
    found = plan(reports.hours_per_employee(logs(spark, {}), staff(spark, {})))
    join = found.index("SortMergeJoin")
    assert "HashAggregate" in found[join:]


def test_streaks_shuffle_days_twice(spark):
    found = plan(reports.attendance_streaks(logs(spark, {})))
    assert len(re.findall(r"Exchange (hash|range)partitioning", found)) == 2


def test_stored_shifts_are_pruned(spark, tmp_path):
    sinks.load_time_logs(str(tmp_path), logs(spark, {}), 1)
    stored = sinks.time_logs(spark, str(tmp_path)).filter(
        "log_month = '2024-01' and employee_id = 'E1'"
    )
    found = stored.select("gross_pay")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*log_month", found)
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(employee_id,E1\)", found)
    assert "ReadSchema: struct<employee_id:string,gross_pay:decimal(10,2)>" in found


def test_only_the_buckets_of_a_load_are_read(spark, tmp_path):
    root, attempt = str(tmp_path), sinks.new_attempt()
    every = spark.range(2000).selectExpr("concat('L', id) as log_id")
    sinks.write_ids(root, every, attempt)
    some = every.filter("log_id in ('L7', 'L8', 'L1500')")
    found = sinks.stored_ids(spark, root, [attempt], some)
    text = found._jdf.queryExecution().executedPlan().toString()
    (pruned,) = re.findall(r"PartitionFilters: \[[^\]]*bucket#\d+ IN \(([\d,]+)\)", text) or [""]
    buckets = {r[0] for r in some.select(sinks.id_bucket()).collect()}
    assert pruned and set(map(int, pruned.split(","))) == buckets
    assert {r.log_id for r in found.collect()} >= {"L7", "L8", "L1500"}
    assert found.count() < 2000


def test_costliest_employees_read_the_shifts_once(spark):
    shifts = logs(spark, {"employee_id": "E1"}, {"employee_id": "E2"})
    rows = reports.costliest_employees(shifts, staff(spark, {}, {}))
    rows.collect()
    assert "ReusedExchange" in plan(rows)

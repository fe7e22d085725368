"""Employee directory and raw shifts derived from the given star-schema tables.

The given tables hold no time-clock data. Suppliers stand in for employees and
line items for shifts; the integer formulas below are fixed values shared with
the SQL side of the checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

INGEST_ORDER = ["clock_in", "k1", "k2", "k3", "k4", "k5"]

# The columns read of each table; a fixed schema saves a look into the files.
_COLUMNS = {
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz"
    ),
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _numbered(prefix: str, number: str, width: int) -> str:
    """Number padded with zeros to ``width`` digits; a longer one keeps all its digits."""
    limit = f"{10**width}L"
    return (
        f"concat('{prefix}', if({number} < {limit}, "
        f"substring(cast({number} + {limit} as string), 2, {width}), cast({number} as string)))"
    )


def _staff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier rows as employees, still without the department."""
    return _table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey",
        "s_nationkey",
        "s_name",
        f"{_numbered('EMP', 's_suppkey', 7)} as employee_id",
        """cast(18.50 + cast(cast(round(abs(s_acctbal) * 100) as bigint) % 6651 as decimal(10,0))
           * 0.01 as decimal(8,2)) as pay_rate""",
    )


def _departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey as s_nationkey", "n_name as department"
    )


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _staff(spark, sf_dir)
        .join(_departments(spark, sf_dir), "s_nationkey")
        .selectExpr(
            "employee_id",
            "split_part(s_name, '#', 1) as first_name",
            "split_part(s_name, '#', 2) as last_name",
            "department",
            "pay_rate",
            "date_add(date'2015-01-01', cast(s_suppkey * 37 % 3651 as int)) as hire_date",
            """case s_suppkey % 6 when 4 then 'Inactive' when 5 then 'On Leave'
               else 'Active' end as status""",
            "concat(lower(employee_id), '@example.org') as email",
        )
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their log_id."""
    return _table(spark, sf_dir, "lineitem").selectExpr(
        f"{_numbered('LOG', '(l_orderkey * 10 + l_linenumber)', 9)} as log_id", "*"
    )


def raw_time_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw shifts plus the ingest columns k1..k5 that define the arrival order.

    The joins run line by line towards the smaller tables. Joining supplier and
    nation first would look like a large table to the planner, which takes the
    product of the sizes, and it would broadcast the line items instead.
    """
    timed = _lines(spark, sf_dir).selectExpr(
        "*",
        "(l_orderkey * 7 + l_partkey) % 100 as kind",
        "cast(round(l_extendedprice * 100) as bigint) as price",
        """l_shipdate + interval '1' second * (
             element_at(array(6, 7, 8, 9, 10, 14, 22), l_linenumber) * 3600L
             + l_partkey % 60 * 60 + l_orderkey % 60) as clock_in""",
    )
    staff = _staff(spark, sf_dir).withColumnRenamed("s_suppkey", "l_suppkey")
    return (
        timed.join(staff, "l_suppkey")
        .join(_departments(spark, sf_dir), "s_nationkey")
        .selectExpr(
            "log_id",
            """case l_partkey % 101 when 0 then null when 1 then '' else employee_id end
               as employee_id""",
            "clock_in",
            """clock_in + interval '1' second * case
                 when kind < 5 then null
                 when kind <= 6 then -(3600 + price % 7201)
                 when kind = 7 then 0
                 when kind = 8 then 600
                 when kind = 9 then 90000
                 when kind = 10 then 1800
                 when kind = 11 then 86400
                 when kind = 12 then 28800
                 when kind = 13 then 28801
                 else 14400 + price % 36001 end as clock_out""",
            "if(l_partkey % 97 = 0, null, department) as department",
            "pay_rate",
            "cast(l_shipdate as date) as log_date",
            "l_partkey as k1",
            "l_suppkey as k2",
            "l_shipdate as k3",
            "price as k4",
            "l_quantity as k5",
        )
    )

"""Compare every query with its SQL in DuckDB: names, types, row counts and values."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _sorted(rows, columns: list[str], names: list[str]) -> list[str]:
    order = [columns.index(n) for n in names]
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def differences(found: DataFrame, db: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a query and its SQL; empty when they agree."""
    expected = db.execute(sql)
    columns = [c[0] for c in expected.description]
    kinds = {c[0]: str(c[1]) for c in expected.description}
    if sorted(columns) != sorted(found.columns):
        return [f"columns {sorted(found.columns)} != {sorted(columns)}"]
    problems = [
        f"type of {name}: {kind} != {kinds[name]}"
        for name, kind in found.dtypes
        if KINDS.get(kind) != kinds[name]
    ]
    names = sorted(columns)
    left = _sorted([tuple(r) for r in found.collect()], found.columns, names)
    right = _sorted(expected.fetchall(), columns, names)
    if len(left) != len(right):
        problems.append(f"rows {len(left)} != {len(right)}")
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        problems.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    return problems


def main(sf_dir: str, only: list[str]) -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as contract
    from shiftpay.session import build_session

    spark = build_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    oracle = contract.oracle_sql()
    for name, run in contract.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            result = run(spark, sf_dir)
            problems = differences(result, db, oracle[name]) if name in oracle else ["no oracle"]
            count = db.execute(f"SELECT count(*) FROM ({oracle[name]})").fetchone()[0]
        except Exception as problem:  # noqa: BLE001 - reported and the rest still runs
            problems, count = [str(problem)[:1500]], -1
        print(f"{'ok ' if not problems else 'BAD'} {name} rows={count} {time.time() - start:.2f}s", *problems, flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])

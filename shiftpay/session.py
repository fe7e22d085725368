"""Spark session settings the operators are written for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

SETTINGS = {
    # Shift times carry no zone; a fixed session zone keeps every cast neutral.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Runtime re-planning: joins turn into broadcasts only once the measured
    # size allows it, skewed join partitions are split, small ones merged.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "shiftpay",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings above.

    ``shuffle_partitions`` is the starting number that adaptive execution merges
    down from: about the number of cores locally, and on a cluster the shuffled
    bytes divided by 200 MB or so.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config(
                "spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g")
            ).config("spark.driver.host", "localhost")
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()

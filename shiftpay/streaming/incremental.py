"""Incremental loads: new raw files go through the same steps as a batch run."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from shiftpay import schemas
from shiftpay.plans.load import load_raw
from shiftpay.sources import sinks
from shiftpay.sources.readers import FILE_ORDER, NULL_TOKENS, parse


def raw_file_stream(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """Stream of raw shift CSV files, as text with the file position of each row."""
    reader = (
        spark.readStream.schema(schemas.as_text(schemas.RAW_LOGS))
        .option("header", True)
        .option("enforceSchema", False)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(path).select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )


def table_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Stream of typed Parquet files; the schema holds the columns of the arrival order."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_available(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    ingest_order: list[str] | None = None,
    null_tokens: tuple[str, ...] = NULL_TOKENS,
) -> StreamingQuery:
    """Load every file not loaded yet, then stop; the checkpoint remembers the files.

    Each micro-batch is a load with a number of its own from the tables, which batch runs
    share; the tables remember the stream and micro-batch it came from. One that is played
    again after a failure is passed over if it was committed; what it left otherwise is not
    part of the tables. Ids already met, by any load, are looked up in the stored tables; the stream
    itself keeps no state that grows.

    Without ``ingest_order`` the stream is text from ``raw_file_stream`` and rows
    arrive in file order.
    """

    def load(rows: DataFrame, part: int) -> None:
        spark = rows.sparkSession
        # the id that the checkpoint keeps for this stream through all restarts
        name = spark.read.json(f"{checkpoint}/metadata").first()["id"]
        if sinks.was_loaded(spark, root, name, part):
            return
        now = datetime.now(timezone.utc)
        order = ingest_order
        if order is None:
            lines = rows.withColumn("_line", F.monotonically_increasing_id())
            rows, order = parse(lines, schemas.RAW_LOGS, null_tokens), FILE_ORDER
        load_raw(
            root, rows, order, None, f"{name}-{part}", now, stream=name, part=part
        ).discard()

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

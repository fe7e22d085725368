"""Readers for the raw CSV files and the stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shiftpay import schemas
from shiftpay.sources import files

# Texts that a CSV field may hold for "no value".
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)
# Position of a row in the files it came from; the arrival order of raw shifts.
FILE_ORDER = ["_file", "_block", "_line"]


def parse(
    text: DataFrame, schema: T.StructType, null_tokens: tuple[str, ...] = NULL_TOKENS
) -> DataFrame:
    """Text columns to their types; unreadable and null-token fields become null.

    Columns of ``text`` outside the schema pass through.
    """

    def typed(field: T.StructField) -> Column:
        value = F.col(field.name)
        value = F.when(~value.isin(*null_tokens), value)
        return value.try_cast(field.dataType).alias(field.name)

    extra = [c for c in text.columns if c not in schemas.names(schema)]
    return text.select(*[typed(f) for f in schema.fields], *extra)


def _read_text(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (
        spark.read.schema(schemas.as_text(schema))
        .option("header", True)
        .option("enforceSchema", False)
        .csv(path)
    )


def read_employees(
    spark: SparkSession, path: str, null_tokens: tuple[str, ...] = NULL_TOKENS
) -> DataFrame:
    """Employee CSV (file, folder or glob) with the file position of each row."""
    return _positioned(spark, path, schemas.EMPLOYEES, null_tokens)


def read_time_logs(
    spark: SparkSession, path: str, null_tokens: tuple[str, ...] = NULL_TOKENS
) -> DataFrame:
    """Raw shift CSV with the file position of each row (FILE_ORDER)."""
    return _positioned(spark, path, schemas.RAW_LOGS, null_tokens)


def read_processed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    null_tokens: tuple[str, ...] = NULL_TOKENS,
) -> DataFrame:
    """An exported CSV table with its fixed schema."""
    return parse(_read_text(spark, path, schema), schema, null_tokens)


def _positioned(
    spark: SparkSession, path: str, schema: T.StructType, null_tokens: tuple[str, ...]
) -> DataFrame:
    # A task reads a block front to back, so within a block the generated ids run in
    # line order; across blocks and files the first two columns decide.
    text = _read_text(spark, path, schema).select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    return parse(text, schema, null_tokens)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table with its fixed schema; an empty one when nothing is stored yet."""
    if not files.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)

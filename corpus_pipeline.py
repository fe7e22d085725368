"""From raw documents to packed sequences, one stage after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shiftpay.llm import line_dedup, packing, simhash, suffixes, toxicity
from shiftpay.sources.files import stage

#: The classifier and the near-duplicate groups aren't SQL; tests compare with brute force.
ORACLE_SQL = None


def _documents(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of documents; n_chars, if there, counts what is left of the text."""
    if "n_chars" in columns:
        kind = rows.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast(kind))
    return rows.select(*[F.col(f"`{c}`") for c in columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject; it learns from these and the labels."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = toxicity.scored(docs, model).where("predicted = 0")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that recur across documents."""
    return _documents(line_dedup.drop_recurring_lines(docs), docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: 4-word shingles, 4 bits."""
    return simhash.keep_one(docs, shingle_words=4, max_bits=4)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without strings of 200 bytes that start anywhere else too."""
    return _documents(suffixes.remove_repeats(docs, as_text=True), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens, piece by piece, with their ids."""
    return packing.pack(docs, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("simhash_dedup", drop_near_copies),
    ("suffix_dedup", drop_repeats),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; each result is written and read as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

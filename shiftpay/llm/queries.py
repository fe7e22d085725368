"""One query for each text operator, over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from shiftpay.llm import (
    best_fit,
    bpe,
    fingerprints,
    line_dedup,
    negatives,
    packing,
    pivots,
    sharding,
    simhash,
    spelling,
    suffixes,
    toxicity,
    url_filters,
)

_SQL = Path(__file__).resolve().parent / "sql"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as captures, against a list of their hosts and the domains above them.

    Fetch days, entry days and actions follow from digests of page ids and patterns: a
    listed pattern has one to three entries within a year.
    """
    pages = _table(spark, sf_dir, "pages")
    day_one = F.to_date(F.lit("2024-01-01"))

    def number(text, first: int = 1):
        return F.conv(F.substring(F.md5(text), first, 6), 16, 10).cast("long")

    captures = pages.select(
        "page_id", "url",
        F.date_add(day_one, (number(F.col("page_id").cast("string")) % 365).cast("int")).alias("fetched"),
    )
    host = url_filters.host_of(F.col("url"))
    hosts = pages.select(host.alias("host")).where("host is not null").distinct()
    domain = F.substring_index("host", ".", -2)
    patterns = hosts.select("host").unionByName(hosts.select(domain.alias("host"))).distinct()
    listed = patterns.where(number(F.col("host"), 7) % 2 == 0)
    entry = F.concat_ws(":", "host", F.col("n").cast("string"))
    entries = listed.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(3)))).select(
        F.col("host").alias("pattern"),
        F.element_at(
            F.array(*map(F.lit, url_filters.ACTIONS)), (number(entry, 7) % 3 + 1).cast("int")
        ).alias("action"),
        F.date_add(day_one, (number(entry) % 365).cast("int")).alias("dated"),
    )
    return url_filters.filter_urls(captures, entries)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixes.remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(_table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_recurring_lines(docs).select(
        "doc_id", "n_lines", "n_dropped",
        F.char_length("text").cast("long").alias("n_chars_left"),
        F.md5("text").alias("text_md5"),
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    shown = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.withColumn("fingerprint", shown)


def op9_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_vectors(_table(spark, sf_dir, "embeddings"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(_table(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.best_fit(_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(_table(spark, sf_dir, "embeddings"))


_QUERIES = [
    op1_packing,
    op2_url_filters,
    op3_suffix_dedup,
    op4_sharding,
    op5_fingerprints,
    op6_line_dedup,
    op7_toxicity,
    op8_simhash,
    op9_pivots,
    op10_bpe,
    op11_spelling,
    op12_best_fit,
    op13_hard_negatives,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {p.stem: p.read_text() for p in sorted(_SQL.glob("*.sql"))}

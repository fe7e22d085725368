"""Places and ranks over all rows without sorting all rows in one task.

A plain rank over everything has no partition key, so Spark would send every row to one
task. Here the rows are sorted once by ranges and written, each with its place within its
sort partition; partitions are counted, and the sums over earlier ones give every row its
place in the whole order. Rows of one value may lie in any number of partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shiftpay.sources.files import stage


def with_position(rows: DataFrame, order: list, name: str) -> DataFrame:
    """``rows`` with their place from 1 in the total order ``order``."""
    place = F.monotonically_increasing_id()  # the sort partition above the row within
    staged = stage(rows.orderBy(*order).withColumn("_place", place), "sorted").withColumns(
        {"_piece": F.shiftright("_place", 33), "_row": F.col("_place").bitwiseAND((1 << 33) - 1)}
    )
    earlier = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = (
        staged.groupBy("_piece")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_piece", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    # one row for each sort partition
    return (
        staged.join(F.broadcast(pieces), "_piece")
        .withColumn(name, F.col("_before") + F.col("_row") + 1)
        .select(*rows.columns, name)
    )


def rank_all(rows: DataFrame, value: str, key: str) -> DataFrame:
    """Add ``company_rank`` (ties share it), ``position`` and ``total_rows``.

    Ranks run from the largest ``value`` down; ``position`` breaks ties by ``key``,
    which must be unique.
    """
    placed = with_position(rows, [F.desc(value), key], "position")
    firsts = placed.groupBy(value).agg(F.min("position").alias("company_rank"))
    count = placed.agg(F.count(F.lit(1)).alias("n")).scalar()
    return placed.join(firsts, value).withColumn("total_rows", count)


def dense_rank_within(rows: DataFrame, group: str, value: str) -> DataFrame:
    """Add ``dept_rank``: the dense rank of ``value``, largest first, within ``group``.

    Only distinct values are sorted.
    """
    values = rows.select(group, value).distinct()
    placed = with_position(values, [group, F.desc(value)], "_at")
    firsts = placed.groupBy(group).agg(F.min("_at").alias("_first"))
    ranked = placed.join(firsts, group).select(
        group, value, (F.col("_at") - F.col("_first") + 1).alias("dept_rank")
    )
    return rows.join(ranked, [group, value])


def tile(position: Column, total_rows: Column, tiles: int) -> Column:
    """Tile 1..``tiles`` of a position; the first tiles take the rows left over."""
    size = F.call_function("div", total_rows, F.lit(tiles).cast("bigint"))
    extra = total_rows % tiles
    large = extra * (size + 1)
    in_large = F.call_function("div", position - 1, size + 1) + 1
    after = extra + F.call_function(
        "div", position - 1 - large, F.greatest(size, F.lit(1).cast("bigint"))
    ) + 1
    return F.when(position <= large, in_large).otherwise(after)

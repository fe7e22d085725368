"""Connected components of links that only ever live in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shiftpay.sources.files import stage


def _large_star(links: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to the smallest of its neighbourhood."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours go to the smallest of these."""
    down = links.where("a > b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = (
        down.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    )
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b), root the least node reachable.

    Alternates large and small stars (Kiveris et al. 2014) until every node points at its
    root. A star's centre is found by a minimum, which is combined before the shuffle, and
    the joins meet one row per node, so runtime re-planning can split a centre that has many
    neighbours. Each round is written to the shared folder; the driver sees two sums.
    Null ends and loops are ignored.
    """
    links = stage(
        links.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    before = None
    while True:
        seen = links.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if seen == before or not seen[0]:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = seen
        links = stage(_small_star(_large_star(links)), "links")

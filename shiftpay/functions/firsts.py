"""Marking the first row per key, exact under any skew of the key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

# A key is hot with more rows than this and than this part of all rows.
HOT_ROWS = 500
HOT_PART = 256
# keys that the count for it keeps at a time; many times HOT_PART, so none is overlooked
_TRACKED = 4096


def mark_repeats(
    rows: DataFrame,
    key: str,
    order_by: list[str],
    flag: str,
    earlier: DataFrame | None = None,
    keep_known: bool = True,
) -> DataFrame:
    """Add the boolean ``flag``: false on the first row of each key, true on the others.

    First is by ``order_by``, which must tell rows of a key apart unless they are
    equal in every column. Null keys form one group. ``earlier`` (one column, ``key``) lists
    keys that came before all rows: every row of these is a repeat, or with ``keep_known``
    off left out.

    A row is moved once, to the others of its key. Only rows of hot keys, which a scan of the
    keys finds beforehand, are numbered once more ahead of that, among the rows of their key
    that were read by the same task; the first of each task then go to the others, and rows
    already known as repeats by groups of their own. So a key that holds a third of all rows is
    as many rows in the last step as it had tasks reading it, and no task gets more of it than
    it read.
    """
    # The hash adds nothing to the grouping. It leads the sort, where eight bytes of it
    # tell most rows apart; ids that start alike would be compared in full. Rows are dealt by
    # key ahead of that, so the hash, which doesn't compress, is worked out where they arrive.
    id_ = [F.xxhash64(key), F.col(key)]
    hot = _hot_keys(rows, key)
    added, repeat = [], F.lit(False)
    if hot:
        is_hot = F.xxhash64(key).isin(hot)
        some = rows.filter(is_hot)
        if earlier is not None and not keep_known:
            # hot keys only, so there are few
            few = F.broadcast(earlier.filter(is_hot).select(F.col(key).alias("_known")))
            some = some.join(few, F.col(key).eqNullSafe(F.col("_known")), "left_anti")
        in_task = Window.partitionBy("_task", *id_).orderBy(*order_by)
        nth = F.row_number().over(in_task)
        some = some.withColumn("_task", F.spark_partition_id()).withColumn("_nth", nth)
        # null for the first of a task, so that these meet; others stay with their own task
        some = some.withColumn("_apart", F.when(F.col("_nth") > 1, F.col("_task"))).drop("_task", "_nth")
        alone = F.lit(None).cast("int").alias("_apart")
        rows = rows.filter(~is_hot).select("*", alone).unionByName(some)
        added, repeat = ["_apart"], F.col("_apart").isNotNull()
    of_key = Window.partitionBy(*id_, *added)
    if earlier is None:
        rows = rows.repartition(key, *added)
        again = F.row_number().over(of_key.orderBy(*order_by)) > 1
        return rows.withColumn(flag, again | repeat).drop(*added)
    # Earlier keys go in ahead of the rows and are taken out again, so the same shuffle
    # serves both tests.
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema if f.name != key]
    rows = rows.withColumn("_new", F.lit(True)).unionByName(
        earlier.select(key, *empty, F.lit(False).alias("_new"))
    ).repartition(key, *added)
    in_order = of_key.orderBy("_new", *order_by)
    again, unknown = F.row_number().over(in_order) > 1, F.first("_new").over(in_order)
    marked = rows.withColumns({flag: again | repeat, "_unknown": unknown})
    wanted = F.col("_new") if keep_known else F.col("_new") & F.col("_unknown")
    return marked.filter(wanted).drop(*added, "_new", "_unknown")


def _hot_keys(rows: DataFrame, key: str) -> list[int]:
    """Hashes of the keys that no task should get whole, HOT_PART of them at most."""
    found = (
        rows.select(F.xxhash64(key).alias("hash"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.expr(f"approx_top_k(hash, {HOT_PART}, {_TRACKED})").alias("top"),
        )
        .first()
    )
    most = max(HOT_ROWS, found["rows"] // HOT_PART)
    return [x["item"] for x in found["top"] or [] if x["count"] > most]

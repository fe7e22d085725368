"""Shards of near-equal size: the minimax contiguous partition of ordered text groups."""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from shiftpay.llm import shared
from shiftpay.sources.files import stage

SHARDS = 24
#: Bytes that a document takes besides its text.
OVERHEAD = 8
#: Key bits that the first summary tells apart, and more bits in each finer one.
_FIRST_BITS = 16
_MORE_BITS = 8


@dataclass(frozen=True, order=True)
class _Stretch:
    """Groups whose keys agree in all but the low ``shift`` bits."""

    low: int
    shift: int
    size: int
    groups: int


def _reach(sums: list[int], stretches: list[_Stretch], start: int, capacity: int, hopeful: bool) -> int:
    """How far a shard that begins at ``start`` gets.

    A stretch of several groups may have a cut anywhere within (hopeful) or nowhere.
    """
    target = start + capacity
    if target >= sums[-1]:
        return sums[-1]
    i = bisect_right(sums, target) - 1
    return target if hopeful and stretches[i].groups > 1 else max(start, sums[i])


def _cuts(sums, stretches, shards: int, capacity: int, hopeful: bool) -> list[int]:
    """Greedy ends of the shards."""
    ends, at = [], 0
    for _ in range(shards):
        at = _reach(sums, stretches, at, capacity, hopeful)
        ends.append(at)
    return ends


def _least(sums, stretches, shards: int, hopeful: bool) -> int:
    """The smallest capacity at which the greedy shards hold everything."""
    low, high = -(-sums[-1] // shards), sums[-1]
    while low < high:
        middle = (low + high) // 2
        if _cuts(sums, stretches, shards, middle, hopeful)[-1] == sums[-1]:
            high = middle
        else:
            low = middle + 1
    return low


def _sums(stretches: list[_Stretch]) -> list[int]:
    sums = [0]
    for s in stretches:
        sums.append(sums[-1] + s.size)
    return sums


def _summary(groups: DataFrame, shift: int, within: list[_Stretch] | None) -> list[_Stretch]:
    """Sizes and numbers of groups by the leading key bits, of some stretches or of all."""
    if within is not None:
        listed = groups.sparkSession.createDataFrame(
            [(s.low >> s.shift,) for s in within], "lead long"
        )
        lead = F.shiftright("key", within[0].shift)
        groups = groups.withColumn("lead", lead).join(F.broadcast(listed), "lead", "left_semi")
    found = groups.groupBy(F.shiftright("key", shift).alias("lead")).agg(
        F.sum("size").alias("size"), F.count("*").alias("groups")
    )
    return [_Stretch(r.lead << shift, shift, r["size"], r.groups) for r in found.collect()]


def cut_keys(groups: DataFrame, shards: int = SHARDS) -> tuple[int, list[int]]:
    """The smallest possible largest shard, and the keys at which shards 1, 2, ... begin.

    ``groups`` are (key, size), each to stay whole, in the order of their 64-bit keys. The
    driver searches on a summary by leading key bits: taking a stretch of several groups as
    divisible gives a capacity that is too small or right, taking it as one block gives one
    that is too large or right. Only the stretches that a cut may fall into are read in more
    detail, until both agree; then the capacity is exact. The summary has 2**16 rows and
    2**8 more for each stretch looked into, whatever the number of groups.
    """
    stretches = sorted(_summary(groups, 64 - _FIRST_BITS, None))
    if not stretches:
        return 0, []
    while True:
        sums = _sums(stretches)
        limit = sums[-1] // (64 * shards)
        finer = [i for i, s in enumerate(stretches) if s.groups > 1 and s.size > limit and s.shift]
        if not finer:
            least = _least(sums, stretches, shards, True)
            most = _least(sums, stretches, shards, False)
            if least == most:
                break
            begins = _cuts(sums, stretches, shards, least, False)
            ends = _cuts(sums, stretches, shards, most, True)
            within: set[int] = set()
            for begin, end in zip(begins, ends):
                first, last = bisect_right(sums, begin) - 1, bisect_right(sums, end) - 1
                within.update(range(max(0, first - 1), min(last + 1, len(stretches))))
            finer = [i for i in sorted(within) if stretches[i].groups > 1 and stretches[i].shift]
            if not finer:  # equal keys only: nothing left to tell apart
                break
        by_shift: dict[int, list[_Stretch]] = {}
        for i in finer:
            by_shift.setdefault(stretches[i].shift, []).append(stretches[i])
        gone = set(finer)
        kept = [s for i, s in enumerate(stretches) if i not in gone]
        for shift, some in by_shift.items():
            kept.extend(_summary(groups, max(0, shift - _MORE_BITS), some))
        stretches = sorted(kept)
    ends = _cuts(sums, stretches, shards, most, False)
    at = {total: i for i, total in enumerate(sums)}
    return most, [stretches[at[e]].low for e in ends if e < sums[-1]]


def shard(docs: DataFrame, shards: int = SHARDS, overhead: int = OVERHEAD) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of docs.

    Equal texts form a group that stays whole; groups are ordered by a 64-bit hash of the
    text, and contiguous runs of them become shards such that the largest is as small as
    possible. Slots number a shard's rows without gaps: each scanned partition counts its
    rows for each shard, sums over partitions give where it begins, and rows are numbered
    within, so a shard of any size needs no task of its own. The rule is ``bytes``;
    ``grown_shard`` belongs to another rule and is null.

    A null text counts as empty: its size is the overhead. With fewer groups than shards
    some stay empty. Repeated rows get slots of their own; an empty table gives none.
    """
    text = shared.text_or_empty()
    rows = stage(
        docs.select(
            "doc_id",
            (F.octet_length(text) + overhead).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            shared.text_key().alias("key"),
            F.spark_partition_id().alias("part"),
        ),
        "shard-rows",
    )
    groups = stage(rows.groupBy("key").agg(F.sum("size").alias("size")), "shard-groups")
    _, keys = cut_keys(groups, shards)
    number = sum(((F.col("key") >= F.lit(k)).cast("int") for k in keys), F.lit(0))
    placed = rows.withColumn("shard", number)
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select(
        "shard", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("begin")
    )
    within = Window.partitionBy("shard", "part").orderBy("key", "doc_id", "text_crc32")
    return (
        placed.withColumn("nth", F.row_number().over(within))
        .join(begins, ["shard", "part"])
        .select(
            "doc_id", "size", "text_crc32",
            F.lit("bytes").alias("law"),
            F.col("shard").cast("int").alias("shard"),
            (F.col("begin") + F.col("nth") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )

"""Embedding near-duplicates through a pivot-permutation index."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shiftpay.llm.components import components
from shiftpay.llm.shared import Forest, mapped
from shiftpay.sources.files import stage

MIN_COSINE = 0.9
#: Reference points, for each dimension, and the distinct vectors they are chosen from.
PIVOTS = 128
SAMPLE = 2048
#: So far below the cosine that links two vectors is that of any two pivots. Those of one
#: cluster would be almost equally near to its vectors, and their order chance.
APART = 0.1
#: Nearest pivots kept, in order, for each vector; shared pivots that make a candidate.
NEAREST = 8
SHARED = 2
#: Rows of one list that meet in one task; longer lists are dealt as pairs of blocks.
LIST_LIMIT = 4096
_PARTS = 64


def _classes(vectors: DataFrame, column: str) -> DataFrame:
    """Distinct usable vectors: digest, values, copies, least id."""
    usable = (
        (F.size(column) > 0)
        & ~F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(column, lambda x: x != 0)
    )
    element = vectors.schema[column].dataType.elementType.simpleString()
    # + 0 makes one zero of both signs
    plain = F.transform(column, lambda x: x + F.lit(0).cast(element))
    rows = vectors.select("vec_id", F.when(usable, plain).alias("values"))
    return rows.withColumn("class", F.when(F.col("values").isNotNull(), F.md5(F.to_json(F.struct("values")))))


def _pivots(classes: DataFrame, pivots: int, bound: float) -> dict[int, np.ndarray]:
    """By dimension, ``pivots`` vectors no two of which are at a cosine of ``bound`` or more.

    They come from a sample, those whose digests sort first in each of _PARTS parts. Fewer
    pivots if the sample has no more that are apart: the less tell vectors apart, the more
    of them meet.
    """
    local = Window.partitionBy("n", "part").orderBy("class")
    few = (
        classes.select("class", "values", F.size("values").alias("n"))
        .withColumn("part", F.pmod(F.xxhash64("class"), F.lit(_PARTS)))
        .withColumn("k", F.row_number().over(local))
        .where(F.col("k") <= SAMPLE // _PARTS)
    )
    found: dict[int, list] = {}
    for r in few.select("n", "values").orderBy("n", "class").collect():
        found.setdefault(r.n, []).append(r["values"])
    return {n: _apart(_unit(np.array(v, np.float64)), pivots, bound) for n, v in found.items()}


def _apart(sample: np.ndarray, pivots: int, bound: float) -> np.ndarray:
    """The first rows, each passed over that is within ``bound`` of one taken before."""
    taken, nearest = [], np.full(len(sample), -2.0)
    for i in range(len(sample)):
        if nearest[i] < bound and len(taken) < pivots:
            taken.append(i)
            nearest = np.maximum(nearest, sample @ sample[i])
    return sample[taken]


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _described(points: dict[int, np.ndarray], nearest: int, shared: int):
    """Batches of classes to one row per inverted list that a vector is entered in.

    A list belongs to ``shared`` pivots that a vector has among its nearest ones; two vectors
    share that many pivots exactly if they meet in a list.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, places, order = [], [], []
            values = batch.column("values").to_pylist()
            sizes = np.array([len(v) for v in values])
            for n in np.unique(sizes):
                rows = np.flatnonzero(sizes == n)
                near = _unit(np.array([values[i] for i in rows], np.float64)) @ points[int(n)].T
                top = np.argsort(-near, axis=1, kind="stable")[:, :nearest]
                lists = _lists(top, len(points[int(n)]), shared)
                keys.append((lists + (int(n) << 40)).ravel())
                places.append(np.repeat(rows, lists.shape[1]))
                order.extend([top[i].astype(np.int16).tobytes()] * lists.shape[1] for i in range(len(rows)))
            if not keys:
                continue
            taken = pa.array(np.concatenate(places))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(keys)),
                    pa.array([x for some in order for x in some], pa.binary()),
                    *[batch.column(c).take(taken) for c in ("class", "copies", "values")],
                ],
                ["list", "nearest", "class", "copies", "values"],
            )

    return work


def _lists(top: np.ndarray, pivots: int, shared: int) -> np.ndarray:
    """Numbers of the lists of each row: one for each ``shared`` of its nearest pivots."""
    ranked = np.sort(top, axis=1).astype(np.int64)
    if top.shape[1] < shared:
        return np.zeros((len(top), 1), np.int64)
    return np.stack(
        [
            sum(ranked[:, p] * pivots**k for k, p in enumerate(some))
            for some in combinations(range(top.shape[1]), shared)
        ],
        axis=1,
    )


def _verified(points: dict[int, int], nearest: int, shared: int, min_cosine: float):
    """Lists to links: for each vector the copies it is linked to, and links that connect."""

    def linked(keys, rows: pa.Table):
        """Links inside one list, or between both blocks of it."""
        n = keys[0] >> 40
        flat = rows.column("values").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        side = rows.column("side").to_numpy()
        unit = _unit(flat.astype(np.float64).reshape(rows.num_rows, -1))
        left = np.flatnonzero(side != 2)
        right = np.flatnonzero(side != 1)
        joined = b"".join(rows.column("nearest").to_pylist())
        order = np.frombuffer(joined, np.int16).reshape(rows.num_rows, -1)
        lists = np.sort(_lists(order, points[n], shared), axis=1)
        own = keys[0] & ((1 << 40) - 1)
        for low in range(0, len(left), 512):
            i = left[low : low + 512]
            a, b = np.nonzero(unit[i] @ unit[right].T >= min_cosine)
            a, b = i[a], right[b]
            if not side.any():  # within one block each pair once
                a, b = a[a < b], b[a < b]
            # a pair that meets in several lists counts in the first of them
            first = np.full(len(a), True)
            for k in range(lists.shape[1]):
                column = lists[a, k]
                first &= ~((column < own) & (lists[b] == column[:, None]).any(axis=1))
            yield a[first], b[first]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def settle(table: pa.Table):
            keys = np.stack([table.column("list").to_numpy(), table.column("pair").to_numpy()])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for start, end in zip(np.r_[0, cuts], np.r_[cuts, table.num_rows]):
                if end - start < 2:
                    continue
                rows = table.slice(start, end - start)
                total, forest = np.zeros(rows.num_rows), Forest(rows.num_rows)
                copies = rows.column("copies").to_numpy()
                for a, b in linked(keys[:, start].tolist(), rows):
                    total += np.bincount(a, copies[b], len(total))
                    total += np.bincount(b, copies[a], len(total))
                    forest.link(a, b)
                some = np.flatnonzero(total)
                if len(some):
                    names = rows.column("class").combine_chunks()
                    yield pa.RecordBatch.from_arrays(
                        [
                            names.take(pa.array(some)),
                            pa.array(total[some].astype(np.int64)),
                            names.take(pa.array(forest.root[some])),
                        ],
                        ["class", "links", "root"],
                    )

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            if held.num_rows >= 2 * LIST_LIMIT:
                last = held.slice(held.num_rows - 1)
                same = (held.column("list").to_numpy() == last.column("list")[0].as_py()) & (
                    held.column("pair").to_numpy() == last.column("pair")[0].as_py()
                )
                cut = held.num_rows - int(same.sum())  # the last list may go on
                yield from settle(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None:
            yield from settle(held)

    return work


def near_vectors(
    vectors: DataFrame,
    column: str = "embedding",
    min_cosine: float = MIN_COSINE,
    pivots: int = PIVOTS,
    nearest: int = NEAREST,
    shared: int = SHARED,
) -> DataFrame:
    """Per row of vectors: vec_id, n_links, component_id, kept.

    Pivots lie apart from each other, so a cluster of near vectors has one of them however
    many vectors it holds. A vector is described by its ``nearest`` nearest pivots in order. It is entered in the
    inverted list of every ``shared`` of them, so those that share that many pivots meet; a
    meeting is a candidate, and the cosine in double precision decides. Equal vectors are one
    entry with a number of copies, and link with each other. A list beyond LIST_LIMIT rows is
    dealt as pairs of blocks, which loses no candidate. Each list gives a count of links for
    each vector and one link to a root, never all pairs.

    Vectors that are null, empty, zero or hold null or non-finite components link with
    nothing; vectors of different lengths don't either. component_id is the least vec_id that
    links lead to; rows with a null vec_id are not kept. An empty table gives none.
    """
    spark = vectors.sparkSession
    rows = stage(_classes(vectors, column), "vectors")
    classes = stage(
        rows.where("class is not null")
        .groupBy("class")
        .agg(F.first("values").alias("values"), F.count("*").alias("copies"), F.min("vec_id").alias("least")),
        "vector-classes",
    )
    points = _pivots(classes, pivots, min_cosine - APART)
    sizes = {n: len(x) for n, x in points.items()}
    values = classes.schema["values"].dataType.simpleString()
    schema = f"list long, nearest binary, class string, copies long, values {values}"
    entries = mapped(
        classes.select("class", "copies", "values"), _described(points, nearest, shared), schema
    )
    entries = stage(entries, "vector-lists")
    long_lists = entries.groupBy("list").count().where(F.col("count") > LIST_LIMIT)
    blocks = F.ceil(F.col("count") / LIST_LIMIT).cast("long")
    marked = entries.join(long_lists, "list", "left").withColumn("blocks", F.coalesce(blocks, F.lit(1)))
    block = F.pmod(F.xxhash64("class"), F.col("blocks"))
    # the pair (i, j), i <= j, of blocks has the number i * blocks + j
    dealt = (
        marked.withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("pair", F.least("block", "other") * F.col("blocks") + F.greatest("block", "other"))
        .withColumn(
            "side",
            F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2),
        )
        .select("list", "pair", "side", "nearest", "class", "copies", "values")
    )
    found = mapped(
        dealt.repartition("list", "pair").sortWithinPartitions("list", "pair", "class"),
        _verified(sizes, nearest, shared, min_cosine),
        "class string, links long, root string",
    )
    found = stage(found, "vector-links")
    linked = found.groupBy("class").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("class").alias("a"), F.col("root").alias("b")))
    named = classes.join(linked, "class", "left").join(
        joined.withColumnRenamed("node", "class"), "class", "left"
    ).withColumn("root", F.coalesce("root", "class"))
    named = stage(named.select("class", "copies", "least", "links", "root"), "vector-groups")
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    labels = named.join(least, "root").select(
        "class", "component", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n")
    )
    return rows.join(labels, "class", "left").select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").cast("long").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component", "vec_id"), F.lit(False)).alias("kept"),
    )

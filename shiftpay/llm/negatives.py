"""Hard negatives by lists of candidates that all anchors of a cluster share."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shiftpay.llm.shared import mapped
from shiftpay.sources.files import new_folder, stage

#: Every so manieth vec_id is an anchor; of every RELABEL-th the label is moved on first.
ANCHORS = 100
RELABEL, LABELS = 7, 10
#: Positives of an anchor, negatives of a positive, and the bounds of a negative's score as
#: percentages of the positive's.
POSITIVES, NEGATIVES = 5, 10
LOWEST, HIGHEST = 30, 90
#: A component times this, rounded down, is what scores are made of.
SCALE = 256
#: Rounded components beyond these bounds are cut to them, so that scores fit a long.
LARGEST = 1 << 24
#: Numbers in the anchors of one block, which the driver hands to all tasks: 8 MB.
BLOCK_NUMBERS = 1 << 20
#: Anchors of a cluster on average, candidates of a list, and list entries tried at a time.
CLUSTER, LIST, STEP = 32, 4096, 128
#: Share of the rows, one in so many, whose best are known before the rest is searched.
FIRST_PART = 16
#: Rounding of a bound, relative to the lengths: an arc cosine near 0 has half the digits.
_SLACK = 1e-6
#: Stands for no score; all others lie between the two.
_NONE, _NEVER = -(1 << 62), 1 << 62


def rounded(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(row, vec_id, label, values): rows that take part, with integer components.

    ``row`` tells rows apart, repeated ones too.
    """
    whole = F.col(column).isNotNull() & ~F.exists(
        column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    label = F.when(F.col("vec_id") % RELABEL == 0, F.pmod(F.col("label") + 1, F.lit(LABELS))).otherwise(F.col("label"))
    bound = F.lit(float(LARGEST))
    number = F.transform(
        column, lambda x: F.greatest(-bound, F.least(bound, F.floor(x.cast("double") * SCALE).cast("double")))
    )
    rows = vectors.where(whole & F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    return rows.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        F.transform(number, lambda x: x.cast("int")).alias("values"),
    )


@dataclass
class Anchors:
    """Anchors of one length and what is searched for: lists of ``k`` for each slot.

    A slot takes scores from low to high, of the anchor's label or of any other; what is worse
    than ``floor`` can't be among its best k.
    """

    row: np.ndarray
    label: np.ndarray
    values: np.ndarray
    same: bool
    k: int
    low: np.ndarray
    high: np.ndarray
    floor: np.ndarray
    norm: np.ndarray = field(init=False)
    clusters: list = field(init=False)

    def __post_init__(self):
        self.norm = np.sqrt((self.values * self.values).sum(axis=1))
        unit = _unit(self.values, self.norm)
        of, centers = _clusters(unit, max(1, len(unit) // CLUSTER))
        self.clusters = []
        for c, center in enumerate(centers):
            members = np.flatnonzero(of == c)
            if len(members):
                cosine = np.clip(unit[members] @ center, -1, 1)
                # an anchor of length zero scores 0 with all, whatever its angle
                angle = np.where(self.norm[members] > 0, np.arccos(cosine), 0).max()
                self.clusters.append((members, center, float(angle)))


def _unit(values: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return values / np.where(norm > 0, norm, 1)[:, None]


def _clusters(unit: np.ndarray, n: int, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Cluster numbers and centres by spherical k-means; any clusters give right results."""
    centers = unit[np.linspace(0, len(unit) - 1, n).astype(int)]
    for _ in range(rounds):
        of = (unit @ centers.T).argmax(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, of, unit)
        size = np.sqrt((sums * sums).sum(axis=1))
        centers = np.where(size[:, None] > 0, sums / np.where(size > 0, size, 1)[:, None], centers)
    return (unit @ centers.T).argmax(axis=1), centers


class Walk:
    """Best candidates of every anchor so far, over the lists walked so far."""

    def __init__(self, anchors: Anchors):
        self._a = anchors
        shape = (*anchors.low.shape, anchors.k)
        self._score, self._id = np.full(shape, _NONE, np.int64), np.zeros(shape, np.int64)

    def add(self, row: np.ndarray, vec_id: np.ndarray, label: np.ndarray, values: np.ndarray) -> None:
        """Walk the list of each cluster over these candidates."""
        norm = np.sqrt((values * values).sum(axis=1))
        unit = _unit(values, norm)
        for members, center, angle in self._a.clusters:
            away = np.where(norm > 0, np.arccos(np.clip(unit @ center, -1, 1)), np.pi / 2)
            # no anchor of the cluster has a larger score with the candidate, over its own length
            bound = norm * np.cos(np.maximum(away - angle, 0))
            bound += _SLACK * norm
            order = np.argsort(-bound, kind="stable")
            self._walk(members, bound[order], row[order], vec_id[order], label[order], values[order])

    def _needed(self, members: np.ndarray) -> np.ndarray:
        """What a candidate must score at least, in any slot, to change an anchor's lists."""
        a = self._a
        return np.maximum(np.maximum(a.low, a.floor)[members], self._score[members, :, -1]).min(axis=1)

    def _walk(self, members, bound, row, vec_id, label, values) -> None:
        a = self._a
        for start in range(0, len(bound), STEP):
            # all that follow are bounded by the first, so walks that need more end here
            members = members[a.norm[members] * bound[start] >= self._needed(members)]
            if not len(members):
                return
            some = slice(start, start + STEP)
            score = _products(a.values[members], values[some])
            alike = a.label[members][:, None] == label[some]
            fits = alike & (a.row[members][:, None] != row[some]) if a.same else ~alike
            score = np.where(fits, score, _NONE)
            for slot in range(a.low.shape[1]):
                self._keep(members, slot, score, vec_id[some])

    def _keep(self, members, slot, score, vec_id) -> None:
        a = self._a
        least = np.maximum(a.low, a.floor)[members, slot]
        least = np.maximum(least, self._score[members, slot, -1])[:, None]
        good = (score >= least) & (score <= a.high[members, slot][:, None]) & (score > _NONE)
        hit = np.flatnonzero(good.any(axis=1))
        if not len(hit):
            return
        own = members[hit]
        scores = np.concatenate([self._score[own, slot], np.where(good[hit], score[hit], _NONE)], axis=1)
        ids = np.broadcast_to(vec_id, (len(hit), len(vec_id)))
        ids = np.concatenate([self._id[own, slot], ids], axis=1)
        best = np.lexsort((ids, -scores), axis=1)[:, : a.k]
        self._score[own, slot] = np.take_along_axis(scores, best, 1)
        self._id[own, slot] = np.take_along_axis(ids, best, 1)

    def found(self) -> tuple[np.ndarray, ...]:
        """Anchors' rows, slots, scores and ids of all entries."""
        at = np.nonzero(self._score > _NONE)
        return self._a.row[at[0]], at[1], self._score[at], self._id[at]


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, as doubles where 53 bits hold them."""
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1] < 2**53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _search(blocks: dict[int, Anchors]):
    """Batches of candidates to the best ones of each anchor and slot in this task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walks = {n: Walk(a) for n, a in blocks.items()}
        held: list[pa.RecordBatch] = []

        def walk() -> None:
            rows = pa.Table.from_batches(held)
            held.clear()
            values = rows.column("values").combine_chunks()
            size = values.value_lengths().to_numpy()
            flat = values.flatten().to_numpy().astype(np.float64)
            place = np.cumsum(size) - size
            row, vec_id, label = (rows.column(c).to_numpy() for c in ("row", "vec_id", "label"))
            for n, one in walks.items():
                some = np.flatnonzero(size == n)
                if len(some):
                    matrix = flat[place[some][:, None] + np.arange(n)]
                    one.add(row[some], vec_id[some], label[some], matrix)

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= LIST:
                walk()
        if held:
            walk()
        for one in walks.values():
            found = one.found()
            for low in range(0, len(found[0]), 1 << 16):
                columns = [pa.array(x[low : low + (1 << 16)].astype(np.int64)) for x in found]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "slot", "score", "id"])

    return work


def _blocks(anchors: DataFrame, columns: list[str]) -> Iterator[list]:
    """Rows of ``anchors`` a block at a time, BLOCK_NUMBERS components in each."""
    held, numbers = [], 0
    for row in anchors.select("row", "vec_id", "label", "values", *columns).toLocalIterator():
        held.append(row)
        numbers += len(row["values"]) + 64
        if numbers >= BLOCK_NUMBERS:
            yield held
            held, numbers = [], 0
    if held:
        yield held


def _best(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _searched(rows: DataFrame, block: list, same: bool, k: int, ranges: str | None) -> DataFrame:
    """(anchor, slot, score, id, rank): the best k of each slot of a block's anchors.

    One part of the rows is searched first. The k-th best score found there is what others
    must reach, so tasks of the second search end their walks early and return little.
    """

    def search(part: DataFrame, floor: dict) -> DataFrame:
        by_size: dict[int, list] = {}
        for r in block:
            by_size.setdefault(len(r["values"]), []).append(r)
        blocks = {n: _anchors(some, same, k, ranges, floor) for n, some in by_size.items()}
        blocks = {n: a for n, a in blocks.items() if a.low.shape[1]}
        return mapped(part, _search(blocks), "anchor long, slot long, score long, id long")

    first = F.pmod(F.xxhash64("row"), F.lit(FIRST_PART)) == 0
    found = stage(_best(search(rows.where(first), {}), k), "first-best")
    floor = {(r.anchor, r.slot): r.score for r in found.where(F.col("rank") == k).collect()}
    rest = search(rows.where(~first), floor)
    return _best(found.drop("rank").unionByName(rest), k)


def _anchors(some: list, same: bool, k: int, ranges: str | None, floor: dict) -> Anchors:
    if ranges is None:
        low = np.full((len(some), 1), _NONE, np.int64)
        high = np.full((len(some), 1), _NEVER, np.int64)
    else:
        slots = max(len(r[ranges]) for r in some)
        low = np.full((len(some), slots), _NEVER, np.int64)
        high = np.full((len(some), slots), _NONE, np.int64)
        for i, r in enumerate(some):
            for j, score in enumerate(r[ranges]):
                least, most = -(-LOWEST * score // 100), HIGHEST * score // 100
                if least <= most:
                    low[i, j], high[i, j] = least, most
    least = np.full(low.shape, _NONE, np.int64)
    for i, r in enumerate(some):
        for j in range(low.shape[1]):
            least[i, j] = floor.get((r.row, j), _NONE)
    return Anchors(
        row=np.array([r.row for r in some], np.int64),
        label=np.array([r.label for r in some], np.int64),
        values=np.array([r["values"] for r in some], np.float64).reshape(len(some), -1),
        same=same, k=k, low=low, high=high, floor=least,
    )


def _all_searched(rows: DataFrame, anchors: DataFrame, same: bool, k: int, ranges: str | None) -> DataFrame:
    """The searches of all blocks of anchors, each written once."""
    spark, schema = rows.sparkSession, "anchor long, slot long, score long, id long, rank int"
    folder, paths = new_folder(spark, "best"), []
    for block in _blocks(anchors, [ranges] if ranges else []):
        paths.append(f"{folder}/block={len(paths)}")
        _searched(rows, block, same, k, ranges).write.parquet(paths[-1])
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def hard_negatives(
    vectors: DataFrame,
    column: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    anchors: int = ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are searched for in blocks of bounded size, against all rows where they lie: no
    vector is shuffled, and no pair but the best is kept. In a task, anchors are clustered by
    direction. For each cluster the candidates at hand are sorted once by the largest score
    that any of its anchors could have with them, an angular bound; every anchor walks that
    list until the bound certifies that nothing further down can enter its lists. Positives
    come first, since their scores bound those of the negatives.

    Rows with a null vec_id, label or vector, or a null or non-finite component take no part.
    Vectors of different lengths are not compared; a zero vector scores 0. Components are
    rounded, then cut to LARGEST either way. Ties go to the smaller vec_id. A repeated row is
    a row of its own, also as an anchor and as a positive of its copy. A positive of negative
    score has no negatives. An empty table gives no row.
    """
    rows = stage(rounded(vectors, column), "vectors")
    chosen = rows.where(F.col("vec_id") % anchors == 0)
    near = stage(_all_searched(rows, chosen, True, positives, None), "positives")
    scores = near.groupBy("anchor").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"]
        ).alias("scores")
    )
    asked = chosen.join(scores, F.col("row") == F.col("anchor")).drop("anchor")
    far = _all_searched(rows, stage(asked, "anchors"), False, negatives, "scores")
    pairs = near.join(
        chosen.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor"
    ).select(
        "anchor", "anchor_id", (F.col("rank") - 1).cast("long").alias("slot"),
        F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
    )
    return pairs.join(far, ["anchor", "slot"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )

"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shiftpay.llm import shared
from shiftpay.sources.files import stage

#: Lengths of n-grams in bytes of the lower-cased text, and buckets they are hashed to.
GRAMS = (2, 3, 4, 5)
BUCKET_BITS = 18
#: Labelled rows of each class that the classifier is fitted on at most, those whose ids
#: have the least hash; and the bytes of text of each class, which bound the fit's memory.
SAMPLE_ROWS = 2000
SAMPLE_BYTES = 8 << 20
#: The part of these bytes beyond which a text comes after all the shorter ones.
LONG_SHARE = 1 / 64
THRESHOLD = 0.3
#: One sample row in so many sets slope and intercept instead of the weights.
CALIBRATE_EVERY = 5
#: Sample rows that an n-gram must occur in.
MIN_ROWS = 3
_SMOOTH, _STEPS, _PENALTY = 1.0, 60, 1e-4


@dataclass
class Model:
    weights: np.ndarray  # one for each bucket, the ratios multiplied in
    bias: float


def _grams(data: np.ndarray, places: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length the buckets of the n-grams, and the places where texts begin in them."""
    sums = shared.prefix_hashes(data)
    shift = np.uint64(64 - BUCKET_BITS)
    for n in GRAMS:
        counts = np.maximum(np.diff(places) - n + 1, 0)
        starts = np.repeat(places[:-1], counts) + shared.ranges(counts)
        h = shared.mixed(shared.substring_hashes(sums, starts, starts + n) + np.uint64(n))
        yield (h >> shift).astype(np.int32), np.r_[0, np.cumsum(counts)]


def distinct_grams(texts: list[str]) -> Iterator[np.ndarray]:
    """The distinct buckets of each whole text."""
    data, places = shared.raw_bytes(pa.array([t.lower() for t in texts], pa.string()))
    found = list(_grams(data, places))
    latest = np.zeros(1 << BUCKET_BITS, np.int32)
    for i in range(len(texts)):
        own = np.concatenate([grams[at[i] : at[i + 1]] for grams, at in found])
        # an n-gram counts where it stands last: that place is the one left in the table
        turn = np.arange(len(own), dtype=np.int32)
        latest[own] = turn
        yield own[latest[own] == turn]


def _fit(labels: np.ndarray, rows: list[np.ndarray]) -> Model:
    """Logistic regression on the ratio-scaled features, by accelerated gradient steps.

    An n-gram that fewer than MIN_ROWS rows have says nothing and gets no weight.
    """
    size, labels = 1 << BUCKET_BITS, labels.astype(np.float64)
    p, q = np.zeros(size), np.zeros(size)
    for mark, row in zip(labels, rows):
        (p if mark else q)[row] += 1
    ratio = np.log((p + _SMOOTH) / (p + _SMOOTH).sum()) - np.log((q + _SMOOTH) / (q + _SMOOTH).sum())
    ratio[p + q < MIN_ROWS] = 0
    order = [i for i, row in enumerate(rows) if len(row)]
    blocks = []
    for low in range(0, len(order), 256):
        some = order[low : low + 256]
        lengths = np.array([len(rows[i]) for i in some])
        blocks.append((np.array(some), lengths, np.concatenate([rows[i] for i in some])))
    squares = ratio * ratio
    reach = np.array([squares[row].sum() for row in rows]) + 1
    # the curvature of the loss is at most a quarter of the mean squared feature length
    rate, share = 4.0 / reach.mean(), 1.0 / len(rows)
    weights, bias = np.zeros(size), 0.0
    ahead, ahead_bias, t = weights, bias, 1.0
    for _ in range(_STEPS):
        scaled, z = ahead * ratio, np.full(len(rows), ahead_bias)
        for some, lengths, flat in blocks:
            z[some] += np.add.reduceat(scaled[flat], np.r_[0, np.cumsum(lengths)[:-1]])
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels
        gradient = np.zeros(size)
        for some, lengths, flat in blocks:
            gradient += np.bincount(flat, np.repeat(error[some], lengths), size)
        gradient = gradient * ratio * share + _PENALTY * ahead
        new, new_bias = ahead - rate * gradient, ahead_bias - rate * error.sum() * share
        turn = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / turn * (new - weights)
        ahead_bias = new_bias + (t - 1) / turn * (new_bias - bias)
        weights, bias, t = new, new_bias, turn
    return Model((weights * ratio).astype(np.float32), float(bias))


def _calibrated(model: Model, labels: np.ndarray, rows: list[np.ndarray], prior: float) -> Model:
    """The model with slope and intercept refitted on rows that it wasn't fitted on, weighted
    to the ``prior``: a logistic regression on its own output, by Newton steps, with targets
    drawn in a little as for few rows."""
    z = np.array([model.weights[row].sum(dtype=np.float64) for row in rows])
    toxic = labels == 1
    clean, marked = (~toxic).sum(), toxic.sum()
    target = np.where(toxic, (marked + 1) / (marked + 2), 1 / (clean + 2))
    weight = np.where(toxic, prior / marked, (1 - prior) / clean) * len(z)
    slope, bias = 1.0, 0.0
    for _ in range(100):
        score = 1 / (1 + np.exp(-np.clip(slope * z + bias, -30, 30)))
        error, bend = weight * (score - target), weight * score * (1 - score)
        cross = (bend * z).sum()
        curvature = [[(bend * z * z).sum() + 1e-3, cross], [cross, bend.sum() + 1e-3]]
        step = np.linalg.solve(curvature, [(error * z).sum(), error.sum()])
        slope, bias = slope - np.clip(step[0], -1, 1), bias - np.clip(step[1], -2, 2)
    return Model((model.weights * slope).astype(np.float32), float(bias))


def held_out(doc_id: Column) -> Column:
    """Whether labels of a row are kept from the fit; so are rows without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from the labelled rows that aren't held out.

    The fit takes up to ``sample_rows`` rows of each class, whole texts, and up to
    SAMPLE_BYTES of text of each, so that both classes weigh alike; slope and intercept
    are then fitted to the share of toxic rows among all of them. Texts over LONG_SHARE of
    these bytes are passed over while there are others, and then taken from the shortest on;
    the first text of a class is taken at any length. Ids without a document take no place. An id that is labelled more than once
    counts as toxic if any label says so. One task fits the model;
    2**BUCKET_BITS weights come to the driver. Without labels of both classes every text gets
    the share of toxic labels as its score, 0 without labels.
    """
    usable = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    classes = {r.toxic: r.n for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    prior = classes.get(1, 0) / max(sum(classes.values()), 1)
    if len(classes) < 2:
        return _flat(prior)

    def order(size: Column) -> list[Column]:
        long = F.when(size > int(SAMPLE_BYTES * LONG_SHARE), size).otherwise(0)
        return [long, F.xxhash64("doc_id"), F.col("doc_id")]

    whole = docs.select("doc_id", shared.text_or_empty().alias("text"))
    sizes = whole.groupBy("doc_id").agg(F.min(F.octet_length("text")).alias("size"))
    sized = stage(usable.join(sizes, "doc_id"), "toxic-sizes")
    some = [
        sized.where(F.col("toxic") == c).orderBy(*order(F.col("size"))).limit(sample_rows)
        for c in (0, 1)
    ]
    chosen = stage(some[0].unionByName(some[1]).drop("size"), "toxic-sample")
    # two classes of at most sample_rows ids: small enough to send to every task
    texts = stage(whole.join(F.broadcast(chosen), "doc_id"), "toxic-texts")
    sums = Window.partitionBy("toxic").orderBy(*order(F.octet_length("text")), "text")
    bounded = (
        texts.withColumn("k", F.row_number().over(sums))
        .withColumn("bytes", F.sum(F.octet_length("text").cast("long")).over(sums))
        .where((F.col("bytes") <= SAMPLE_BYTES) | (F.col("k") == 1))
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, marks = [], []
        for batch in shared.text_slices(batches, "text"):
            rows.extend(distinct_grams(batch.column("text").to_pylist()))
            marks.extend(batch.column("toxic").to_pylist())
        if len(set(marks)) < 2:  # no text of one class
            return
        marks = np.array(marks)
        apart = np.arange(len(rows)) % CALIBRATE_EVERY == 0
        if len(set(marks[apart])) < 2 or len(set(marks[~apart])) < 2:
            apart[:] = False
        model = _fit(marks[~apart], [r for r, x in zip(rows, apart) if not x])
        if apart.any():
            model = _calibrated(model, marks[apart], [r for r, x in zip(rows, apart) if x], prior)
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.bias])],
            ["weights", "bias"],
        )

    one = bounded.select("toxic", "k", "text").coalesce(1).sortWithinPartitions("toxic", "k")
    found = shared.mapped(one, work, "weights binary, bias double").first()
    return Model(np.frombuffer(found.weights, np.float32), found.bias) if found else _flat(prior)


def _flat(prior: float) -> Model:
    """The same score for every text."""
    prior = min(max(prior, 1e-9), 1 - 1e-9)
    return Model(np.zeros(1 << BUCKET_BITS, np.float32), float(np.log(prior / (1 - prior))))


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """docs with ``score`` (0 to 1) and ``predicted`` (1 from the threshold on) added.

    Only the whole text goes into a score; a null text is empty and scores by the intercept.
    Columns of these names are replaced; repeated rows are scored alike.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2**BUCKET_BITS floats
    rows = docs.drop("score", "predicted")
    text = shared.free_name(rows, "whole_text")
    rows = rows.withColumn(text, shared.text_or_empty())
    schema = rows.drop(text).schema.add("score", "double").add("predicted", "integer")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = sent.value.weights, sent.value.bias
        for batch in shared.text_slices(batches, text):
            sums = np.array(
                [weights[g].sum(dtype=np.float64) for g in distinct_grams(batch.column(text).to_pylist())]
            )
            score = 1 / (1 + np.exp(-np.clip(sums + bias, -700, 700)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                names=schema.names,
            )

    return shared.mapped(rows, work, schema)

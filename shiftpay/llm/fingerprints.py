"""Document fingerprints by one-permutation MinHash."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from shiftpay.llm import shared
from shiftpay.sources.files import stage

SHINGLE_WORDS = 5
#: Bins of a fingerprint, a power of two, and the low-order bits stored for each (4 or 8).
BINS = 512
BITS = 4
_DOCS = 2048


@lru_cache(4)
def _donors(bins: int) -> np.ndarray:
    """For each bin the order in which it asks the others: seeded random permutations."""
    draw = np.random.Generator(np.random.PCG64(20240501))
    return np.argsort(draw.random((bins, bins)), axis=1).astype(np.int32)


def sketch(
    data: np.ndarray, places: np.ndarray, shingle_words: int = SHINGLE_WORDS, bins: int = BINS, bits: int = BITS
) -> tuple[np.ndarray, np.ndarray]:
    """Low-order bits per text and bin, and whether a text has words at all.

    Each shingle is hashed once: the leading bits name its bin, and the bin keeps the least
    hash. An empty bin takes over the value of the first bin with one in its own random
    order of bins, so equal sets fill alike and different bins borrow independently. A text
    with fewer words than a shingle is one shingle; without words all its values are 0.
    """
    n = len(places) - 1
    starts, ends, before = shared.words(data, places)
    hashes = shared.mixed(shared.substring_hashes(shared.prefix_hashes(data), starts, ends))
    counts = np.diff(before)
    rows = np.repeat(np.arange(n), np.where(counts, np.maximum(counts - shingle_words + 1, 1), 0))
    shingles = np.where(counts, np.maximum(counts - shingle_words + 1, 1), 0)
    first = before[rows] + shared.ranges(shingles)
    end = before[rows + 1]
    total = np.zeros(len(first), np.uint64)
    for k in range(shingle_words):
        at = first + k
        inside = at < end
        word = hashes[np.minimum(at, max(len(hashes) - 1, 0))] if len(hashes) else hashes
        total = total * np.uint64(shared.BASE) + np.where(inside, word, np.uint64(0))
    total = shared.mixed(total)
    shift = 64 - (bins.bit_length() - 1)
    least = np.full(n * bins, np.iinfo(np.uint64).max, np.uint64)
    filled = np.zeros(n * bins, bool)
    at = rows * bins + (total >> np.uint64(shift)).astype(np.int64)
    np.minimum.at(least, at, total)
    filled[at] = True
    filled = filled.reshape(n, bins)
    values, some = least.reshape(n, bins), filled.any(axis=1)
    row, hole = np.nonzero(~filled & some[:, None])
    ask = _donors(bins)
    for turn in range(bins):
        if not len(row):
            break
        donor = ask[hole, turn]
        found = filled[row, donor]
        values[row[found], hole[found]] = values[row[found], donor[found]]
        row, hole = row[~found], hole[~found]
    # stirred with the bin's number, so that bins with one borrowed value differ by chance
    # alone where texts differ
    stirred = shared.mixed(values + np.arange(bins, dtype=np.uint64) * np.uint64(shared.BASE))
    low = (stirred & np.uint64((1 << bits) - 1)).astype(np.uint8)
    low[~some] = 0
    return low, some


def packed(values: np.ndarray, bits: int = BITS) -> list[bytes]:
    """Fingerprints as bytes, two 4-bit values or one 8-bit value each."""
    if bits == 4:
        values = (values[:, 0::2] << 4) | values[:, 1::2]
    return [row.tobytes() for row in np.ascontiguousarray(values)]


def likeness(a: np.ndarray, b: np.ndarray, some_a: np.ndarray, some_b: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Estimated Jaccard similarity: the share of equal values, less what chance makes equal.

    Two texts without words are alike (1); one with and one without are not (0).
    """
    chance = 2.0**-bits
    raw = ((a == b).mean(axis=1) - chance) / (1 - chance)
    return np.where(some_a & some_b, np.clip(raw, 0, 1), (some_a == some_b).astype(float))


def _sketched(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    parts = []
    for low in range(0, len(texts), _DOCS):
        parts.append(sketch(*shared.raw_bytes(pa.array(texts[low : low + _DOCS], pa.string()))))
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the beginning of another."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def _compared(texts: list[str], following: list[str], own, after) -> list[pa.Array]:
    """Columns of the result, of texts with their sketches and those that follow them."""
    changed = [edited(t, f) for t, f in zip(texts, following)]
    values, some = own
    new, new_some = _sketched(changed)
    return [
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
        pa.array(packed(values), pa.binary()),
        pa.array(packed(new), pa.binary()),
        pa.array(likeness(values, new, some, new_some)),
        pa.array(likeness(values, after[0], some, after[1])),
    ]


_FIELDS = "n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every text and of an edit of it that borrows from the next document.

    Next is by descending doc_id (nulls last, then by a digest of the text), and the first
    follows the last. One shuffle sorts the texts by ranges of the id, so most documents meet
    the next one in their own task; each task passes on its first and last document, and
    these few are matched in a second small job.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (lowercase hex),
    near_edited and near_next. A null text is empty; repeated rows are documents of their
    own; a single document is its own next; an empty table gives none.
    """
    rows = docs.select("doc_id", shared.text_or_empty().alias("text"))
    order = [F.desc_nulls_last("doc_id"), F.asc("tie")]
    dealt = (
        rows.withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )
    key = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {key}, {_FIELDS}, role string, part long, text string"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, waiting, any_row = TaskContext.get().partitionId(), None, False

        def border(role, row):
            nothing = [pa.nulls(1, f.type) for f in _arrow(schema_types[1:7])]
            return pa.RecordBatch.from_arrays(
                [row[0], *nothing, pa.array([role]), pa.array([part]), pa.array([row[1]], pa.string())],
                names=names,
            )

        for batch in shared.text_slices(batches, "text"):
            ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            values, some = _sketched(texts)
            if not any_row:
                any_row = True
                yield border("first", (ids.slice(0, 1), texts[0]))
            if waiting is not None:
                ids = pa.concat_arrays([waiting[0], ids])
                texts = [waiting[1], *texts]
                values = np.concatenate([waiting[2], values])
                some = np.concatenate([waiting[3], some])
            waiting = (ids.slice(len(ids) - 1), texts[-1], values[-1:], some[-1:])
            n = len(texts) - 1
            if n:
                made = _compared(texts[:-1], texts[1:], (values[:-1], some[:-1]), (values[1:], some[1:]))
                blank = [pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string())]
                yield pa.RecordBatch.from_arrays([ids.slice(0, n), *made, *blank], names=names)
        if waiting is not None:
            yield border("last", waiting)

    names = ["doc_id", *[f.split()[0] for f in _FIELDS.split(", ")], "role", "part", "text"]
    schema_types = [key, *[f.split()[1] for f in _FIELDS.split(", ")]]
    found = stage(shared.mapped(dealt, work, schema), "fingerprints")
    borders = found.where("role is not null").select("role", "part", "doc_id", "text")
    firsts = borders.where("role = 'first'").select("part", F.col("text").alias("following"))
    # one row for each task: the task that comes after it, the first one after the last
    turn = Window.orderBy("part")
    tasks = firsts.select("part").withColumn(
        "next",
        F.coalesce(
            F.lead("part").over(turn),
            F.first("part").over(turn.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        ),
    )
    last = (
        borders.where("role = 'last'")
        .join(tasks, "part")
        .join(firsts.withColumnRenamed("part", "next"), "next")
        .select("doc_id", "text", "following")
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in shared.text_slices(batches, "text"):
            texts, following = (batch.column(c).to_pylist() for c in ("text", "following"))
            made = _compared(texts, following, _sketched(texts), _sketched(following))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], names=names[:7])

    rest = shared.mapped(last, finish, f"doc_id {key}, {_FIELDS}")
    whole = found.where("role is null").drop("role", "part", "text").unionByName(rest)
    return whole.withColumns(
        {c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")}
    )


def _arrow(types: list[str]) -> list[pa.Field]:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64()}
    return [pa.field("x", kinds[t]) for t in types]

"""Helpers of the text operators: row keys, batches as bytes, hashes of substrings."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

#: Bytes of text worked on at a time inside a task, unless one text alone is longer.
SLICE_BYTES = 1 << 20
#: Bytes of a batch that goes to a Python worker, unless the session says otherwise: the
#: buffers of both sides lie outside the heap, and with long texts the default takes a lot.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
_MASK = (1 << 64) - 1
#: Odd multipliers of the 64-bit mixing step and of the substring hashes.
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
BASE = 0x9E3779B97F4A7C15


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def text_key(column: str = "text") -> Column:
    """A 64-bit digest of the text; beside the id it tells rows apart."""
    return F.xxhash64(text_or_empty(column))


def id_key_of_null() -> Column:
    return F.lit(-(2**63)).cast("long")


def id_key(column: str = "doc_id") -> Column:
    """The id as a join key that nulls share."""
    return F.coalesce(F.col(column).cast("long"), id_key_of_null())


def free_name(rows: DataFrame, name: str) -> str:
    """``name`` with underscores in front until no column of ``rows`` has it."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def mapped(rows: DataFrame, work: Callable, schema) -> DataFrame:
    """mapInArrow whose workers can import this package.

    Workers on this machine find it by the path added here; those of a cluster by the
    archive that the job is submitted with (``--py-files``), and the path is ignored.
    Batches are small where the session sets no size of its own.
    """
    settings = rows.sparkSession.conf
    if BATCH_BYTES[0] not in settings.getAll:
        settings.set(*BATCH_BYTES)
    root = str(Path(__file__).resolve().parents[2])
    environment = rows.sparkSession.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(":"):
        environment["PYTHONPATH"] = ":".join(filter(None, [root, environment.get("PYTHONPATH")]))
    return rows.mapInArrow(work, schema)


def text_slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of about SLICE_BYTES of ``column``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(
            zero_copy_only=False
        )
        block = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for start, end in itertools.pairwise(cuts):
            yield batch.slice(start, end - start)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return pc.fill_null(batch.column(column), "").to_pylist()


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values end to end and the n + 1 places where values begin and end."""
    values = pa.concat_arrays([column.cast(pa.binary())])
    values = pc.fill_null(values, b"")
    _, places, data = values.buffers()
    places = np.frombuffer(places, np.int32)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[places[0] : places[-1]], (places - places[0]).astype(np.int64)


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit values stirred so that every bit depends on all."""
    h = h ^ (h >> np.uint64(30))
    h = h * _MIX
    h ^= h >> np.uint64(27)
    h *= _MIX2
    h ^= h >> np.uint64(31)
    return h


class Powers:
    """Powers of the base, and of its inverse, modulo 2**64."""

    def __init__(self, base: int = BASE):
        self._base, self._inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) <= n:
            size = max(n + 1, 2 * len(self.up))
            for name, factor in (("up", self._base), ("down", self._inverse)):
                steps = np.full(size, factor & _MASK, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))


POWERS = Powers()


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Sums of (byte + 1) * base**-place over every prefix, modulo 2**64."""
    POWERS.reach(len(data))
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * POWERS.down[: len(data)], out=sums[1:])
    return sums


def substring_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of the substrings, whatever their place."""
    return (sums[ends] - sums[starts]) * POWERS.up[starts]


def words(data: np.ndarray, places: np.ndarray):
    """Starts and ends of the words of all texts (runs without ASCII white space), and the
    number of words before each text."""
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    before = np.empty(len(data), bool)
    if len(data):
        before[0] = False
        before[1:] = inside[:-1]
        firsts = places[:-1]
        before[firsts[firsts < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    last = np.empty(len(data), bool)
    if len(data):
        last[-1] = True
        last[:-1] = ~inside[1:]
        lasts = places[1:] - 1
        last[lasts[lasts >= 0]] = True
    ends = np.flatnonzero(inside & last) + 1
    return starts, ends, np.searchsorted(starts, places)


def ranges(counts: np.ndarray) -> np.ndarray:
    """0 .. count - 1 for each count, end to end."""
    total = np.cumsum(counts)
    return np.arange(total[-1] if len(total) else 0) - np.repeat(total - counts, counts)


class Forest:
    """Roots of linked places, kept flat."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.root[a], self.root[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while (flat := self.root[self.root]).tobytes() != self.root.tobytes():
                self.root = flat

"""Packing by bounded-space online best-fit: whole documents into few sequences."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from shiftpay.llm import shared
from shiftpay.llm.encoder import encoder
from shiftpay.sources.files import new_folder, stage_in

WINDOW = 2048
#: The id put after each document.
END = 0
#: Bins that are open at a time in a task.
OPEN_BINS = 512
#: Tasks whose last bins are packed once more, together.
TASKS_TOGETHER = 16
#: Rows handed on at a time.
_ROWS = 4096


class Bins:
    """Open bins by their free space: bit f of a number tells whether any has f free.

    A piece goes to the bin with the least space that holds it. Where a new bin would be
    one too many, the fullest is closed first.
    """

    def __init__(self, window: int, limit: int):
        self._window, self._limit = window, limit
        self._free: list[list[int]] = [[] for _ in range(window + 1)]
        self._mask = self._open = self._next = 0

    def put(self, length: int) -> tuple[int, int, list[int]]:
        """Bin and offset of a piece of 1 to ``window`` ids, and the bins that closed."""
        closed = []
        fits = self._mask >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            if self._open == self._limit:
                closed.append(self._take((self._mask & -self._mask).bit_length() - 1))
            free, number = self._window, self._next
            self._next += 1
        left = free - length
        if left:
            self._free[left].append(number)
            self._mask |= 1 << left
            self._open += 1
        else:
            closed.append(number)
        return number, self._window - free, closed

    def _take(self, free: int) -> int:
        number = self._free[free].pop()
        if not self._free[free]:
            self._mask ^= 1 << free
        self._open -= 1
        return number


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = zip(*held)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
        )

    for row in rows:
        held.append(row)
        if len(held) == _ROWS:
            yield batch()
            held = []
    if held:
        yield batch()


def _pieces(
    batches: Iterator[pa.RecordBatch], path: str, window: int, end: int, with_ids: bool
) -> Iterator[tuple]:
    """(kept columns ..., piece, start, length, crc32, ids) of each piece."""
    last = end.to_bytes(4, "little")
    for batch in shared.text_slices(batches, "text"):
        ids, places = encoder(path).ids(batch.column("text"))
        kept = zip(*[c.to_pylist() for c in batch.columns[:-1]])
        for row, first, stop in zip(kept, places[:-1].tolist(), places[1:].tolist()):
            whole = ids[first:stop].astype("<u4").tobytes() + last
            size = stop - first + 1
            for piece, start in enumerate(range(0, size, window)):
                length = min(window, size - start)
                part = memoryview(whole)[4 * start : 4 * (start + length)]
                shown = bytes(part) if with_ids else None
                yield *row, piece, start, length, zlib.crc32(part), shown


def _online(window: int, open_bins: int, cut: Callable) -> Callable:
    """Pieces in the order they come; those of bins left open at the end get no bin."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        task = TaskContext.get().partitionId()
        bins, held = Bins(window, open_bins), {}
        for piece in cut(batches):
            number, offset, closed = bins.put(piece[-3])
            held.setdefault(number, []).append((*piece, task, (task << 32) + number, offset))
            for done in closed:
                yield from held.pop(done)
        for some in held.values():
            yield from ((*row[:-2], None, None) for row in some)

    return rows


def best_fit(
    docs: DataFrame,
    path: str | None = None,
    window: int = WINDOW,
    end: int = END,
    open_bins: int = OPEN_BINS,
    columns: list[str] | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of documents, packed into as few sequences of at most ``window`` ids as it can.

    Each task packs its documents as they come, by best-fit over ``open_bins`` open bins:
    only documents of more than ``window`` ids are cut, into pieces of ``window`` and a last
    one. What lies in the bins that are open when a task ends is packed anew with that of
    TASKS_TOGETHER tasks, longest pieces first, with all their bins open: there are at most
    open_bins * TASKS_TOGETHER of them. A task holds only pieces of open bins, and only such
    pieces are shuffled, without texts.

    Returns ``columns`` of docs (doc_id by default), piece, start, length, ids_crc32,
    sequence_id, offset, and with ``with_ids`` the ids. A null or empty text is ``end`` alone;
    repeated rows are packed as often as they occur; an empty table gives no piece. A very
    long text is worked on at once, in one task, at some 30 bytes a token.
    """
    kept = columns or ["doc_id"]
    path = path or public_tokenizers.path("word_bpe_49k.json")
    rows = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(kept)], "text")
    added = ["piece", "start", "length", "ids_crc32"]
    schema = T.StructType(rows.drop("text").schema.fields)
    for name in added:
        schema = schema.add(name, T.IntegerType() if name == "piece" else T.LongType())
    schema = schema.add("ids", "binary")
    for name in ("task", "sequence_id", "offset"):
        schema = schema.add(name, "long")

    def online(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = _online(window, open_bins, lambda b: _pieces(b, path, window, end, with_ids))
        yield from _batches(work(batches), arrow)

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, bins = None, None
        for batch in batches:
            found = []
            for task, length in zip(batch.column("task").to_pylist(), batch.column("length").to_pylist()):
                if task // TASKS_TOGETHER != group:
                    group = task // TASKS_TOGETHER
                    bins = Bins(window, open_bins * TASKS_TOGETHER)
                number, offset, _ = bins.put(length)
                found.append(((1 << 62) + (group << 32) + number, offset))
            numbers = [pa.array(x, pa.int64()) for x in zip(*found)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *numbers], schema=arrow)

    arrow = _arrow(schema)
    placed = stage_in(shared.mapped(rows, online, schema), new_folder(docs.sparkSession, "best-fit"))
    group = F.floor(F.col("task") / TASKS_TOGETHER)
    last = (
        placed.where("sequence_id is null")
        .repartition(group)
        .sortWithinPartitions(group, F.desc("length"), "task")
    )
    packed = placed.where("sequence_id is not null").unionByName(shared.mapped(last, together, schema))
    return packed.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(kept)],
        *added, "sequence_id", "offset", *(["ids"] if with_ids else []),
    )


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)

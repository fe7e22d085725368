"""Packing by concatenate and cut: documents end to end, cut into fixed windows."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from shiftpay.llm import shared
from shiftpay.llm.encoder import encoder
from shiftpay.sources.files import stage

WINDOW = 2048
#: The id put after each document.
END = 1


def tokenized(docs: DataFrame, path: str, end: int = END, columns: list[str] | None = None) -> DataFrame:
    """``columns`` of docs, ids as 32-bit numbers with ``end`` after them, and first sums.

    The ids are those that the tokenizers library gives for the file ``path``, whatever its
    rules; strings of added tokens in a text get the added tokens' ids.

    ``tokens_before`` counts the ids of earlier rows in the same task ``task``: the first
    pass of the prefix sums.
    """
    kept = columns or ["doc_id"]
    names = ["ids", "n_ids", "task", "tokens_before"]
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(kept)], "text")
    schema = T.StructType(rows.drop("text").schema.fields).add("ids", "binary")
    for name in names[1:]:
        schema = schema.add(name, "long")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, before = TaskContext.get().partitionId(), 0
        for batch in shared.text_slices(batches, "text"):
            found, places = encoder(path).ids(batch.column("text"))
            data = np.insert(found, places[1:], end).astype("<u4")
            places = places + np.arange(len(places))  # each text has one id more
            sizes = np.diff(places)
            ids = pa.Array.from_buffers(
                pa.binary(), len(sizes), [None, *map(pa.py_buffer, ((4 * places).astype(np.int32), data))]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    ids,
                    pa.array(sizes),
                    pa.array(np.full(len(sizes), task, np.int64)),
                    pa.array(before + places[:-1]),
                ],
                names=schema.names,
            )
            before += int(places[-1])

    return shared.mapped(rows, work, schema)


def pack(
    docs: DataFrame,
    path: str | None = None,
    window: int = WINDOW,
    end: int = END,
    columns: list[str] | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of the documents in sequences of ``window`` ids, all documents end to end.

    Pass one tokenizes each document once, writes the ids to the shared folder, and counts
    them within each task. The task totals, one row a task, are summed up in order; a
    document's place in the endless row of ids is its task's sum plus its own. Pass two reads
    the ids where they lie and cuts them at each multiple of ``window``; a document that
    crosses one becomes several pieces, its boundary records. Only the last sequence is
    short. No ids are shuffled.

    Returns ``columns`` of docs (doc_id by default), start, length, ids_crc32, doc_tokens,
    sequence_id, offset, and with ``with_ids`` the ids. A null or empty text is ``end``
    alone; repeated rows are packed as often as they occur; an empty table gives no piece.
    """
    kept = columns or ["doc_id"]
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    ids = stage(tokenized(docs, path, end, kept), "packed-ids")
    totals = ids.groupBy("task").agg(F.sum("n_ids").alias("n"))
    order = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = totals.select("task", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("task_before"))
    # one row for each task of the first pass, so the sums fit in any executor
    placed = ids.join(F.broadcast(firsts), "task").select(
        *[f"k{i}" for i in range(len(kept))],
        "ids",
        (F.col("task_before") + F.col("tokens_before")).alias("place"),
    )
    added = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = T.StructType(placed.drop("ids", "place").schema.fields)
    for name in added:
        schema = schema.add(name, "long")
    if with_ids:
        schema = schema.add("ids", "binary")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in shared.text_slices(batches, "ids"):
            data = batch.column("ids")
            place = batch.column("place").to_numpy()
            sizes = _lengths(data)
            first, last = place // window, (place + sizes - 1) // window
            counts = last - first + 1
            row = np.repeat(np.arange(len(place)), counts)
            sequence = first[row] + shared.ranges(counts)
            begin = np.maximum(sequence * window, place[row])
            stop = np.minimum((sequence + 1) * window, (place + sizes)[row])
            start = begin - place[row]
            views = [memoryview(x.as_buffer()) for x in data]
            cut = [
                views[r][4 * a : 4 * b]
                for r, a, b in zip(row.tolist(), start.tolist(), (stop - place[row]).tolist())
            ]
            columns = [c.take(pa.array(row)) for c in batch.columns[: len(kept)]]
            numbers = [
                start, stop - begin, np.array([zlib.crc32(x) for x in cut], np.int64),
                sizes[row], sequence, begin - sequence * window,
            ]
            columns.extend(pa.array(x.astype(np.int64)) for x in numbers)
            if with_ids:
                columns.append(pa.array([bytes(x) for x in cut], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    packed = shared.mapped(placed, work, schema)
    return packed.withColumnsRenamed({f"k{i}": c for i, c in enumerate(kept)})


def _lengths(data: pa.Array) -> np.ndarray:
    return pc.binary_length(data).to_numpy(zero_copy_only=False).astype(np.int64) // 4

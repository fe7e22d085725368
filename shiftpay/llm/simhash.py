"""SimHash near-duplicates: fingerprints, and a binary-trie self-join within a bit distance."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from shiftpay.llm import shared
from shiftpay.llm.components import components
from shiftpay.sources.files import stage

SHINGLE_WORDS = 4
MAX_BITS = 4
_SEED = 42
#: Fingerprints that one trie may hold before its key is split once more.
TRIE_LIMIT = 50_000
#: Fingerprints and node pairs worked on at a time in a task.
_GROUP = 400_000
_PAIRS = 1 << 19


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of a whole text: a bit is 1 if set in over half of the shingle hashes."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    lengths = [len(w) + 1 for w in found]
    starts = [0, *accumulate(lengths)]
    span = min(shingle_words, len(found))
    counts, n = np.zeros(64, np.int64), len(found) - span + 1
    hashed = xxhash.xxh64_intdigest
    for low in range(0, n, 1 << 15):
        high = min(n, low + (1 << 15))
        h = np.array(
            [
                hashed(joined[a : b - 1], _SEED)
                for a, b in zip(starts[low:high], starts[low + span : high + span])
            ],
            np.uint64,
        )
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, columns: list[str] | None = None
) -> DataFrame:
    """``columns`` of docs (doc_id by default) and ``fingerprint``, a signed 64-bit number.

    Words are runs without ASCII white space, A-Z lower-cased; repeats of a shingle count.
    Fewer words than a shingle: all of them; none, or a null text: 0.
    """
    kept = columns or ["doc_id"]
    rows = docs.select(*kept, F.col("text").alias("_text"))
    schema = rows.drop("_text").schema.add("fingerprint", "long")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in shared.text_slices(batches, "_text"):
            found = [fingerprint(t, shingle_words) for t in shared.texts(batch, "_text")]
            columns = [batch.column(c) for c in kept]
            columns.append(pa.array(np.array(found, np.uint64).view(np.int64)))
            yield pa.RecordBatch.from_arrays(columns, [*kept, "fingerprint"])

    return shared.mapped(rows, work, schema)


def _blocks(max_bits: int, low: int, high: int) -> list[tuple[int, int]]:
    """(first bit, width) of max_bits + 1 stretches that make up the bits low .. high - 1.

    Two numbers that differ in at most max_bits bits agree in one stretch at least.
    """
    edges = [low + (high - low) * i // (max_bits + 1) for i in range(max_bits + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _keys(value: Column, blocks: list[tuple[int, int]]) -> Column:
    return F.array(
        *[
            F.shiftrightunsigned(value, a).bitwiseAND(F.lit((1 << w) - 1)) + F.lit(i << 32)
            for i, (a, w) in enumerate(blocks)
        ]
    )


def trie_links(
    values: np.ndarray, trees: np.ndarray, max_bits: int, width: int = 64
) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what lies within ``max_bits`` differing bits in the same tree.

    ``values`` are sorted unsigned numbers within each of the sorted ``trees``. Each tree is
    a binary trie over the sorted numbers, a node being a range of places that share their
    leading bits. Node pairs go down together, all trees at once: the children of a pair
    carry the bits that differ so far, a pair beyond the budget is dropped with everything
    below it, and two leaves are settled by the rest of their bits. Returns a spanning
    forest of the links found, not all of them.
    """
    n = len(values)
    forest = shared.Forest(n)
    firsts = np.flatnonzero(np.r_[True, trees[1:] != trees[:-1]]) if n else np.zeros(0, int)
    sizes = np.diff(np.r_[firsts, n])
    big = sizes > 1
    firsts, sizes = firsts[big], sizes[big]
    zeros = np.zeros(len(firsts), np.int64)
    # a pair: begin and end of either node, bits that differ so far, depth of both
    waiting = [(firsts, firsts + sizes, firsts, firsts + sizes, zeros, width)]
    while waiting:
        a0, a1, b0, b1, wrong, depth = waiting.pop()
        if len(a0) > _PAIRS:
            half = len(a0) // 2
            waiting.append((a0[half:], a1[half:], b0[half:], b1[half:], wrong[half:], depth))
            waiting.append((a0[:half], a1[:half], b0[:half], b1[:half], wrong[:half], depth))
            continue
        leaves = (a1 - a0 == 1) & (b1 - b0 == 1)
        if leaves.any():
            x, y = a0[leaves], b0[leaves]
            near = np.bitwise_count(values[x] ^ values[y]) <= max_bits
            forest.link(x[near], y[near])
            rest = ~leaves
            a0, a1, b0, b1, wrong = a0[rest], a1[rest], b0[rest], b1[rest], wrong[rest]
        if depth and len(a0):
            bit = np.uint64(depth - 1)
            same = (a0 == b0) & (a1 == b1)
            am, bm = _halves(values, a0, a1, bit), _halves(values, b0, b1, bit)
            below = [
                (a0, am, b0, bm, wrong, slice(None)),
                (am, a1, bm, b1, wrong, slice(None)),
                (a0, am, bm, b1, wrong + 1, slice(None)),
                (am, a1, b0, bm, wrong + 1, ~same),  # of a pair with itself, once
            ]
            parts = []
            for s0, s1, t0, t1, w, some in below:
                keep = (s1 > s0) & (t1 > t0) & (w <= max_bits)
                keep &= ~((s1 - s0 == 1) & (s0 == t0) & (s1 == t1))
                if not isinstance(some, slice):
                    keep &= some
                parts.append([x[keep] for x in (s0, s1, t0, t1, w)])
            waiting.append((*map(np.concatenate, zip(*parts)), depth - 1))
    moved = np.flatnonzero(forest.root != np.arange(n))
    return moved, forest.root[moved]


def _halves(values: np.ndarray, begin: np.ndarray, end: np.ndarray, bit: np.uint64) -> np.ndarray:
    """Where each node's half with ``bit`` set begins, by binary search."""
    low, high = begin.copy(), end.copy()
    while (low < high).any():
        middle = (low + high) // 2
        inside = low < high
        is_set = (values[np.minimum(middle, len(values) - 1)] >> bit) & np.uint64(1) == 1
        high = np.where(inside & is_set, middle, high)
        low = np.where(inside & ~is_set, middle + 1, low)
    return low


def _tries(max_bits: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def settle(rows: pa.Table):
            keys = rows.column("key").to_numpy()
            values = rows.column("value").to_numpy().view(np.uint64)
            order = np.lexsort((values, keys))
            keys, values = keys[order], values[order]
            x, y = trie_links(values, keys, max_bits)
            return pa.RecordBatch.from_arrays(
                [pa.array(values[x].view(np.int64)), pa.array(values[y].view(np.int64))],
                ["a", "b"],
            )

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= _GROUP:
                rows = pa.Table.from_batches(held)
                keys = rows.column("key").to_numpy()
                cut = int(np.searchsorted(keys, keys[-1]))  # the last tree may go on
                if cut:
                    yield settle(rows.slice(0, cut))
                    held = rows.slice(cut).combine_chunks().to_batches()
        if held:
            yield settle(pa.Table.from_batches(held))

    return work


def near_links(values: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) that connect distinct ``value`` numbers within ``max_bits`` bits.

    The 64 bits are cut into max_bits + 1 stretches; numbers that agree in one stretch meet
    in the trie of that stretch's value. A trie over TRIE_LIMIT numbers is cut again by the
    stretches of the whole number's other bits, which keeps every link: within it, what
    differs in at most max_bits bits again agrees in one of max_bits + 1 stretches. Each
    trie returns a spanning forest, so a group of n near copies gives under n links a trie.
    """
    spark = values.sparkSession
    blocks = _blocks(max_bits, 0, 64)
    keyed = values.select("value", F.explode(_keys(F.col("value"), blocks)).alias("key"))
    sizes = keyed.groupBy("key").count().where(F.col("count") > TRIE_LIMIT)
    hot = [r.key for r in sizes.select("key").orderBy("key").collect()]  # at most all keys: 5 * 2**13
    halves = keyed
    if hot:
        listed = F.broadcast(spark.createDataFrame([(k,) for k in hot], "key long"))
        plain = keyed.join(listed, "key", "left_anti")
        finer = []
        for i, (start, width) in enumerate(blocks):
            # the bits outside stretch i, moved together, then cut anew
            rest = F.shiftrightunsigned("value", start + width) if start + width < 64 else F.lit(0).cast("long")
            joined = F.shiftleft(rest, start).bitwiseOR(
                F.col("value").bitwiseAND(F.lit((1 << start) - 1))
            )
            part = keyed.join(listed, "key").where(F.shiftright("key", 32) == i)
            again = part.select(
                "value", "key", F.explode(_keys(joined, _blocks(max_bits, 0, 64 - width))).alias("next")
            )
            finer.append(again.select("value", F.xxhash64("key", "next").alias("key")))
        halves = reduce(DataFrame.unionByName, [plain.select("value", "key"), *finer])
    dealt = halves.select("key", "value").repartition("key").sortWithinPartitions("key")
    return shared.mapped(dealt, _tries(max_bits), "a long, b long")


def groups(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    columns: list[str] | None = None,
) -> DataFrame:
    """``columns`` of every row of docs, ``fingerprint``, and ``component_id``.

    Rows whose fingerprints differ in at most ``max_bits`` bits are linked; component_id is
    the least doc_id that links lead to, the row's own included. Equal fingerprints are one
    node from the start, however many rows have them. Null ids are never the least unless
    all of a group are null; a null or empty text has fingerprint 0 and is linked like any
    other. Repeated rows come out as often as they went in; an empty table gives none.
    component_id doesn't name a group: those without any id share null, and those that share
    their least id share that.
    """
    kept = columns or ["doc_id"]
    return _rooted(docs, shingle_words, max_bits, kept).select(*kept, "fingerprint", "component_id")


def _rooted(docs: DataFrame, shingle_words: int, max_bits: int, kept: list[str]) -> DataFrame:
    """groups() with ``root``, a fingerprint that each group has to itself."""
    marked = stage(fingerprints(docs, shingle_words, kept), "simhash")
    classes = marked.groupBy(F.col("fingerprint").alias("value")).agg(F.min("doc_id").alias("least"))
    classes = stage(classes, "simhash-classes")
    found = components(near_links(classes.select("value"), max_bits))
    found = classes.join(found, classes.value == found.node, "left").select(
        "value", "least", F.coalesce("root", "value").alias("root")
    )
    least = found.groupBy("root").agg(F.min("least").alias("component_id"))
    named = found.join(least, "root").select("value", "root", "component_id")
    return marked.join(named, marked.fingerprint == named.value).select(
        *kept, "fingerprint", "component_id", "root"
    )


def keep_one(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """The rows of docs, one of each group: that with the least doc_id.

    Of rows that share this id, the one whose text sorts first by its digest stays. Rows of a
    group whose ids are all null keep one as well.
    """
    names = [shared.free_name(docs, n) for n in ("row_id", "row_text")]
    keyed = docs.select(
        "doc_id", "text", shared.text_key().alias(names[1])
    )
    found = _rooted(keyed.select("doc_id", "text", names[1]), shingle_words, max_bits, ["doc_id", names[1]])
    # equal (id, text digest): the same row repeated, of which one stays as well
    first = found.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", names[1])).alias("first")
    )
    chosen = first.select(
        shared.id_key("first.doc_id").alias("_id"), F.col(f"first.{names[1]}").alias("_key")
    )
    rows = docs.withColumn(names[0], shared.id_key()).withColumn(names[1], shared.text_key())
    kept = rows.join(
        chosen, (rows[names[0]] == chosen["_id"]) & (rows[names[1]] == chosen["_key"]), "left_semi"
    )
    return _once(kept, names).select(*docs.columns)


def _once(rows: DataFrame, names: list[str]) -> DataFrame:
    """Rows that share id and text digest, once; hardly any do, so one aggregate serves."""
    others = [c for c in rows.columns if c not in names]
    firsts = [F.first(F.col(f"`{c}`")).alias(c) for c in others]
    return rows.groupBy(*names).agg(*firsts)

"""Dedup of repeated byte strings by a hash-compared sort of suffixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from shiftpay.llm import shared
from shiftpay.sources.files import stage

LENGTH = 200
#: Bytes of an anchor: of the anchors' hashes that a window holds, the least is its own.
ANCHOR = 32
#: Surroundings of one anchor that are sorted in one task; beyond, windows are counted by digest.
ANCHOR_LIMIT = 2000
_GROUP_BYTES = 1 << 20


#: Bits of an anchor's hash that count in the choice; the rest hold its place.
_PLACE_BITS = 22


def _least_places(hashes: np.ndarray, span: int) -> np.ndarray:
    """For each run of ``span`` hashes the place of the least, leftmost of equal ones."""
    mask = np.uint64((1 << _PLACE_BITS) - 1)
    found, step = [], (1 << _PLACE_BITS) - span
    for low in range(0, len(hashes) - span + 1, step):
        part = hashes[low : low + step + span - 1]
        keys = (part & ~mask) | np.arange(len(part), dtype=np.uint64)
        padded = np.full(-(-len(part) // span) * span, np.iinfo(np.uint64).max, np.uint64)
        padded[: len(part)] = keys
        blocks = padded.reshape(-1, span)
        # a run is the end of one block and the beginning of the next
        head = np.minimum.accumulate(blocks, axis=1).ravel()
        tail = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(tail[: len(part) - span + 1], head[span - 1 : len(part)])
        found.append((least & mask).astype(np.int64) + low)
    return np.concatenate(found)


def window_anchors(
    data: np.ndarray, places: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR
) -> tuple[np.ndarray, ...]:
    """Anchors of all windows of ``length`` bytes: text, place, first and last window, hash.

    A window's anchor is the string of ``anchor`` bytes inside it with the least hash, the
    leftmost of equal ones; so equal windows have equal anchors at the same place in them,
    and the windows of one anchor lie next to each other. Places are those in ``data``.
    """
    span = length - anchor + 1
    windows = np.maximum(np.diff(places) - length + 1, 0)
    if not windows.any():
        return (*(np.zeros(0, np.int64) for _ in range(4)), np.zeros(0, np.uint64))
    sums = shared.prefix_hashes(data)
    count = len(data) - anchor + 1
    hashes = shared.mixed((sums[anchor:] - sums[:-anchor]) * shared.POWERS.up[:count])
    starts = np.repeat(places[:-1], windows) + shared.ranges(windows)
    text = np.repeat(np.arange(len(windows)), windows)
    place = _least_places(hashes, span)[starts]
    first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (text[1:] != text[:-1])])
    last = np.r_[first[1:], len(starts)] - 1
    return text[first], place[first], starts[first], starts[last], hashes[place[first]]


def _anchors(length: int, anchor: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in shared.text_slices(batches, "text"):
            data, places = shared.raw_bytes(batch.column("text"))
            text, place, first, last, gram = window_anchors(data, places, length, anchor)
            view, digest = memoryview(data), xxhash.xxh3_64_intdigest
            around = np.fromiter(
                (
                    digest(view[a:b], seed)
                    for a, b, seed in zip(
                        first.tolist(), (last + length).tolist(), (place - first).tolist()
                    )
                ),
                np.uint64,
                len(first),
            )
            base, taken = places[text], pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(taken),
                    batch.column("digest").take(taken),
                    pa.array((place - base).astype(np.int32)),
                    pa.array((first - base).astype(np.int32)),
                    pa.array((last - first + 1).astype(np.int32)),
                    pa.array(gram.view(np.int64)),
                    pa.array(around.view(np.int64)),
                ],
                ["id", "digest", "place", "first", "windows", "gram", "around"],
            )

    return work


class Suffixes:
    """Suffixes of some bytes, compared by hashes of their beginnings.

    The common extension of two suffixes is found by binary search over its length, each
    step comparing two polynomial hashes, and the byte after it decides their order: a
    comparison takes a number of steps logarithmic in ``length``, beyond which suffixes
    count as equal.
    """

    def __init__(self, data: np.ndarray, length: int = LENGTH):
        self.data, self.length = data, length
        self._sums = shared.prefix_hashes(data)

    def hashes(self, at: np.ndarray, count) -> np.ndarray:
        return shared.substring_hashes(self._sums, at, at + count)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of each pair, up to ``length``."""
        low = np.zeros(len(a), np.int64)
        whole = self.hashes(a, self.length) == self.hashes(b, self.length)
        low[whole] = self.length
        rest = np.flatnonzero(~whole)
        a, b = a[rest], b[rest]
        begin, end = np.zeros(len(rest), np.int64), np.full(len(rest), self.length - 1)
        while (begin < end).any():
            middle = (begin + end + 1) // 2
            same = self.hashes(a, middle) == self.hashes(b, middle)
            begin, end = np.where(same, middle, begin), np.where(same, end, middle - 1)
        low[rest] = begin
        return low

    def before(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether suffix a comes before b, or where asked for equals it."""
        common = self.common(a, b)
        equal = common == self.length
        top = len(self.data) - 1
        less = self.data[np.minimum(a + common, top)] < self.data[np.minimum(b + common, top)]
        return np.where(equal, or_equal, less)

    def sort(self, at: np.ndarray, part: np.ndarray) -> np.ndarray:
        """The suffixes at these places in order within each part: a merge sort.

        ``part`` is ascending. Runs double in length; a suffix's place in the merged run is
        its place in its own run plus its rank in the other one, found by binary search, for
        all suffixes of all parts at once.
        """
        begins = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        sizes = np.diff(np.r_[begins, len(part)])
        begin = np.repeat(begins, sizes)
        size = np.repeat(sizes, sizes)
        at, width = at.copy(), 1
        while width < (sizes.max() if len(sizes) else 0):
            live = np.flatnonzero(size > width)
            index = live - begin[live]
            run = index // width
            other = (run ^ 1) * width
            low = np.minimum(other, size[live])
            high = np.minimum(other + width, size[live])
            origin, right = low.copy(), (run & 1).astype(bool)
            value = at[live]
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                middle = (low[open_] + high[open_]) // 2
                there = at[begin[live[open_]] + middle]
                # an element of the right run comes after equal ones of the left run
                passed = self.before(there, value[open_], right[open_])
                low[open_] = np.where(passed, middle + 1, low[open_])
                high[open_] = np.where(passed, high[open_], middle)
            target = begin[live] + (run // 2) * 2 * width + index % width + (low - origin)
            at[target] = value
            width *= 2
        return at

    def same_bytes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the first ``length`` bytes of both really are the same."""
        reach, found = np.arange(self.length), np.zeros(len(a), bool)
        for low in range(0, len(a), 16384):
            some = slice(low, low + 16384)
            found[some] = (
                self.data[a[some, None] + reach] == self.data[b[some, None] + reach]
            ).all(axis=1)
        return found


def repeated_windows(
    data: np.ndarray, base: np.ndarray, before: np.ndarray, windows: np.ndarray,
    group: np.ndarray, length: int = LENGTH,
) -> tuple[np.ndarray, np.ndarray]:
    """Which windows of some surroundings occur in another one as well: (which, window).

    ``base`` is where each surrounding begins in ``data``, ``before`` its bytes ahead of
    the anchor. Only windows of one ``group`` (anchor) that hold the anchor at the same
    place can be equal, so suffixes are sorted within these. A window whose whole hash
    nobody shares equals no other and isn't sorted. Neighbours in the order that extend over
    ``length`` bytes are compared byte by byte.
    """
    which = np.repeat(np.arange(len(base)), windows)
    window = shared.ranges(windows)
    at = base[which] + window
    suffixes = Suffixes(data, length)
    hashes = suffixes.hashes(at, length)
    order = np.argsort(hashes, kind="stable")
    twice = np.r_[False, hashes[order][1:] == hashes[order][:-1]]
    twice[:-1] |= twice[1:]
    some = np.sort(order[twice])
    which, window, at = which[some], window[some], at[some]
    slot = before[which] - window  # bytes ahead of the anchor in the window
    part = group[which] * np.int64(length + 1) + slot
    order = np.argsort(part, kind="stable")
    sorted_ = suffixes.sort(at[order], part[order])
    part = part[order]
    near = np.flatnonzero(part[1:] == part[:-1])
    near = near[suffixes.common(sorted_[near], sorted_[near + 1]) == length]
    near = near[suffixes.same_bytes(sorted_[near], sorted_[near + 1])]
    found = np.unique(np.r_[sorted_[near], sorted_[near + 1]])
    of = np.searchsorted(base, found, side="right") - 1
    return of, found - base[of]


def _grouped(batches: Iterator[pa.RecordBatch], key: str, column: str) -> Iterator[pa.Table]:
    """Sorted rows in tables that hold whole keys, of some MB where keys allow."""
    held: list[pa.Table] = []
    size = 0
    for batch in shared.text_slices(batches, column):
        held.append(pa.Table.from_batches([batch]))
        size += batch.nbytes
        if size >= _GROUP_BYTES:
            table = pa.concat_tables(held)
            keys = table.column(key).to_numpy()
            cut = int(np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])[-1])
            if cut:
                yield table.slice(0, cut)
                table = table.slice(cut)
            held, size = [table], table.nbytes if cut else 0
    if held:
        yield pa.concat_tables(held)


_SURROUNDING = "gram long, single boolean, id long, digest long, first int, before int, windows int, bytes binary"


def _surroundings(length: int):
    """Texts with the anchors wanted of each to the bytes around them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in shared.text_slices(batches, "text"):
            wanted = batch.column("wanted")
            flat = wanted.flatten()
            row = np.repeat(
                np.arange(batch.num_rows), np.diff(wanted.offsets.to_numpy().astype(np.int64))
            )
            fields = {f: flat.field(f) for f in ("place", "first", "windows", "gram", "single")}
            data, places = shared.raw_bytes(batch.column("text"))
            first, windows = fields["first"].to_numpy(), fields["windows"].to_numpy()
            begin = places[row] + first
            end = begin + windows + (length - 1)
            raw = data.tobytes()
            taken = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    fields["gram"], fields["single"],
                    batch.column("id").take(taken), batch.column("digest").take(taken),
                    fields["first"], pa.array(fields["place"].to_numpy() - first), fields["windows"],
                    pa.array([raw[a:b] for a, b in zip(begin.tolist(), end.tolist())], pa.binary()),
                ],
                ["gram", "single", "id", "digest", "first", "before", "windows", "bytes"],
            )

    return work


def _sorted_spans(length: int):
    """Surroundings, those of an anchor together, to the spans that repeat."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches, "gram", "bytes"):
            rows = table.combine_chunks().to_batches()[0]
            data, base = shared.raw_bytes(rows.column("bytes"))
            gram = rows.column("gram").to_numpy()
            group = np.cumsum(np.r_[0, gram[1:] != gram[:-1]])
            of, window = repeated_windows(
                data, base[:-1], rows.column("before").to_numpy().astype(np.int64),
                rows.column("windows").to_numpy().astype(np.int64), group, length,
            )
            alone = rows.column("single").to_numpy(zero_copy_only=False)[of]
            of, window = of[alone], window[alone]
            if not len(of):
                continue
            new = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (window[1:] != window[:-1] + 1)])
            stop = np.r_[new[1:], len(of)] - 1
            taken, first = pa.array(of[new]), rows.column("first").to_numpy()[of[new]]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("id").take(taken), rows.column("digest").take(taken),
                    pa.array((first + window[new]).astype(np.int32)),
                    pa.array((first + window[stop] + length).astype(np.int32)),
                ],
                ["id", "digest", "begin", "end"],
            )

    return work


def _block_width(length: int) -> int:
    """Windows of a block: about as many as a surrounding has blocks."""
    return max(1, round((length - ANCHOR + 1) ** 0.5))


def _blocks(length: int):
    """Surroundings to blocks of their windows, by the bytes ahead of the anchor in a window.

    ``key`` is a hash of the bytes that all windows of the block have in common, so equal windows
    lie in blocks of one key; ``cover`` a digest of all bytes that those held here cover.
    """
    width = _block_width(length)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in shared.text_slices(batches, "bytes"):
            before = batch.column("before").to_numpy().astype(np.int64)
            windows = batch.column("windows").to_numpy().astype(np.int64)
            low, high = (before - windows + 1) // width, before // width
            row = np.repeat(np.arange(len(before)), high - low + 1)
            block = low[row] + shared.ranges(high - low + 1)
            ahead = before[row]
            inner = ahead - block * width, ahead - (block + 1) * width + 1 + length
            begin = np.maximum(ahead - (block + 1) * width + 1, 0)
            end = np.minimum(inner[0] + 1, windows[row])  # windows begin .. end - 1
            texts = batch.column("bytes").to_pylist()
            keys, covers = np.empty(len(row), np.uint64), []
            for k, (r, a, b, c, d, n, h) in enumerate(
                zip(*(x.tolist() for x in (row, *inner, begin, end, block, ahead)))
            ):
                keys[k] = xxhash.xxh3_64_intdigest(texts[r][a:b], n)
                covers.append(xxhash.xxh3_128_digest(texts[r][c : d - 1 + length], h - c))
            taken = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys.view(np.int64)), pa.array(covers, pa.binary()),
                    *(batch.column(c).take(taken) for c in ("single", "gram", "id", "digest", "first")),
                    pa.array(begin.astype(np.int32)), pa.array(end.astype(np.int32)),
                ],
                ["key", "cover", "single", "gram", "id", "digest", "first", "begin", "end"],
            )

    return work


_BLOCK = (
    "key long, cover binary, single boolean, gram long, id long, digest long, first int, begin int, end int"
)


def _counted_windows(length: int):
    """Surroundings to one 128-bit digest for each window of the blocks ``asked`` of them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in shared.text_slices(batches, "bytes"):
            asked = batch.column("asked")
            flat = asked.flatten()
            begin, end = (flat.field(f).to_numpy().astype(np.int64) for f in ("begin", "end"))
            of = np.repeat(
                np.arange(batch.num_rows), np.diff(asked.offsets.to_numpy().astype(np.int64))
            )
            part = np.repeat(np.arange(len(begin)), end - begin)
            row, window = of[part], begin[part] + shared.ranges(end - begin)
            texts = batch.column("bytes").to_pylist()
            found = [
                xxhash.xxh3_128_digest(texts[r][w : w + length])
                for r, w in zip(row.tolist(), window.tolist())
            ]
            taken = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found, pa.binary()), flat.field("alone").take(pa.array(part)),
                    batch.column("id").take(taken), batch.column("digest").take(taken),
                    pa.array((batch.column("first").to_numpy()[row] + window).astype(np.int32)),
                ],
                ["window", "alone", "id", "digest", "begin"],
            )

    return work


def _hot_spans(around: DataFrame, length: int) -> list[DataFrame]:
    """Spans that repeat among the surroundings of anchors with very many.

    Their windows are taken in blocks. Parts that cover the same bytes repeat whole. Only where
    a block's common bytes stand in parts that differ, and one of these is the only of its kind,
    is each window of one part of a kind counted by its digest, combined before the shuffle.
    """
    blocks = stage(shared.mapped(around, _blocks(length), _BLOCK), "blocks")
    place = ["gram", "id", "digest", "first"]
    kinds = stage(
        blocks.groupBy("key", "cover").agg(
            F.count("*").alias("n"), F.min(F.struct(*place, "single", "begin", "end")).alias("one")
        ),
        "block-kinds",
    )
    alone = (F.col("n") == 1) & F.col("one.single")
    mixed = (
        kinds.groupBy("key")
        .agg(F.count("*").alias("kinds"), F.max(alone).alias("alone"))
        .where("kinds > 1 and alone")
        .select("key")
    )
    asked = (
        kinds.join(mixed, "key", "left_semi")
        .select("one.*", alone.alias("alone"))
        .groupBy(*place)
        .agg(F.collect_list(F.struct("begin", "end", "alone")).alias("asked"))
    )
    # rows that are equal in all of these have the same bytes, one of them stands for all
    held = around.dropDuplicates(place).join(asked, place)
    counted = stage(
        shared.mapped(
            held.select("id", "digest", "first", "bytes", "asked"),
            _counted_windows(length),
            "window binary, alone boolean, id long, digest long, begin int",
        ),
        "counted-windows",
    )
    several = counted.groupBy("window").agg(F.count("*").alias("n")).where("n > 1")
    same = blocks.where("single").join(kinds.where("n > 1").select("key", "cover"), ["key", "cover"], "left_semi")
    return [
        counted.where("alone").join(several, "window", "left_semi")
        .select("id", "digest", "begin", (F.col("begin") + length).alias("end")),
        same.select(
            "id", "digest", (F.col("first") + F.col("begin")).alias("begin"),
            (F.col("first") + F.col("end") - 1 + length).alias("end"),
        ),
    ]


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(id, digest, spans): for each row with any, spans of bytes that repeat elsewhere.

    Every window of ``length`` bytes has an anchor (see window_anchors). Windows can only
    be equal if their anchors are, so the work goes on with anchors that occur twice. Where
    the whole surroundings of an anchor (all its windows) occur twice, all of them repeat,
    and this takes a digest; only where surroundings differ, at the borders of repeated
    passages and edits, are their bytes fetched, once for each different one, and the
    suffixes sorted anchor by anchor. An anchor with more than ANCHOR_LIMIT different
    surroundings has its windows counted by digest instead, see _hot_spans.
    """
    rows = docs.select(
        shared.id_key().alias("id"), shared.text_key().alias("digest"), shared.text_or_empty().alias("text")
    ).where(F.octet_length("text") >= length)
    schema = "id long, digest long, place int, first int, windows int, gram long, around long"
    anchors = stage(shared.mapped(rows, _anchors(length, ANCHOR), schema), "anchors")
    # written, so that runtime re-planning can split an anchor that many texts share
    twice = stage(
        anchors.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), "repeated-grams"
    )
    anchors = stage(anchors.join(twice, "gram", "left_semi"), "repeated-anchors")
    kinds = stage(
        anchors.groupBy("gram", "around").agg(
            F.count("*").alias("n"),
            F.min(F.struct("id", "digest", "place", "first", "windows")).alias("one"),
        ),
        "anchor-kinds",
    )
    mixed = (
        kinds.groupBy("gram")
        .agg(F.count("*").alias("kinds"), F.min("n").alias("least"))
        .where("kinds > 1 and least = 1")
    )
    wanted = kinds.join(mixed, "gram").select(
        "gram", (F.col("n") == 1).alias("single"), "one.*", (F.col("kinds") > ANCHOR_LIMIT).alias("hot")
    )
    by_text = wanted.groupBy("id", "digest").agg(
        F.collect_list(F.struct("place", "first", "windows", "gram", "single")).alias("wanted")
    )
    held = rows.join(by_text, ["id", "digest"])
    around = stage(
        shared.mapped(held.select("id", "digest", "text", "wanted"), _surroundings(length), _SURROUNDING),
        "surroundings",
    )
    hot = stage(mixed.where(F.col("kinds") > ANCHOR_LIMIT).select("gram"), "hot-anchors")
    plain = around
    spans = []
    if not hot.isEmpty():
        plain = around.join(hot, "gram", "left_anti")
        spans += _hot_spans(around.join(hot, "gram", "left_semi").select(*around.columns), length)
    dealt = plain.repartition("gram").sortWithinPartitions("gram")
    spans.append(
        shared.mapped(
            dealt.select(*around.columns), _sorted_spans(length), "id long, digest long, begin int, end int"
        )
    )
    whole = anchors.join(kinds.where("n > 1").select("gram", "around"), ["gram", "around"], "left_semi")
    spans.append(
        whole.select(
            "id", "digest", F.col("first").alias("begin"),
            (F.col("first") + F.col("windows") + (length - 1)).alias("end"),
        )
    )
    found = spans[0]
    for more in spans[1:]:
        found = found.unionByName(more)
    return found.groupBy("id", "digest").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))


def _removed(text: bytes, spans: np.ndarray) -> tuple[bytes, int]:
    """The bytes outside all spans, and the number of maximal runs taken out."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.flatnonzero(np.r_[True, spans[1:, 0] > reach[:-1]])
    begins, ends = spans[new, 0], reach[np.r_[new[1:], len(spans)] - 1]
    kept = [text[a:b] for a, b in zip([0, *ends.tolist()], [*begins.tolist(), len(text)])]
    return b"".join(kept), len(new)


def remove_repeats(docs: DataFrame, length: int = LENGTH, as_text: bool = False) -> DataFrame:
    """docs with ``kept`` (the remaining bytes), ``n_bytes``, ``n_removed``, ``n_spans``.

    With ``as_text`` the remaining bytes take the place of ``text`` instead, less any byte
    of a character that was cut through; a null text then stays null.

    A byte goes if a string of ``length`` bytes that covers it starts anywhere else too, in
    this text or another, overlaps included, judged on the input. Strings never cross texts.
    A null text is empty; texts under ``length`` bytes stay whole; repeated rows are copies
    of each other; columns of the added names are replaced; an empty table gives none.
    """
    rows = docs.drop("kept", "n_bytes", "n_removed", "n_spans")
    names = [shared.free_name(rows, n) for n in ("span_id", "span_digest", "span_list", "span_text")]
    spans = repeated_spans(docs, length).toDF(*names[:3])
    joined = rows.withColumn(names[3], shared.text_or_empty()).join(
        spans, (shared.id_key() == F.col(names[0])) & (shared.text_key() == F.col(names[1])), "left"
    )
    kept = rows.columns
    joined = joined.select(*[F.col(f"`{c}`") for c in kept], names[3], names[2])
    schema = joined.drop(names[3], names[2]).schema
    if not as_text:
        schema = schema.add("kept", "binary")
    for name in ("n_bytes", "n_removed", "n_spans"):
        schema = schema.add(name, "long")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in shared.text_slices(batches, names[3]):
            raw = batch.column(names[3]).cast(pa.binary()).to_pylist()
            lists, found = batch.column(names[2]), []
            for text, some in zip(raw, lists):
                if not some.is_valid:
                    found.append((text, 0))
                    continue
                some = some.values
                pairs = [some.field(f).to_numpy().astype(np.int64) for f in ("begin", "end")]
                found.append(_removed(text, np.stack(pairs, axis=1)))
            sizes = np.array([len(t) for t in raw], np.int64)
            left = np.array([len(t) for t, _ in found], np.int64)
            columns = batch.columns[: len(kept)]
            if as_text:
                at = kept.index("text")
                decoded = [
                    t.decode("utf-8", "ignore") if valid else None
                    for (t, _), valid in zip(found, columns[at].is_valid().to_pylist())
                ]
                columns[at] = pa.array(decoded, pa.string())
            else:
                columns.append(pa.array([t for t, _ in found], pa.binary()))
            runs = pa.array([n for _, n in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sizes), pa.array(sizes - left), runs], names=schema.names
            )

    return shared.mapped(joined, work, schema)

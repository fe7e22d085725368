"""Byte-level BPE by prefix dynamic programming: the last token of every byte prefix."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, types as T

from shiftpay.llm import shared
from shiftpay.llm.pieces import Pieces, gathered

#: Odd multiplier that spreads pairs of tokens over slots.
_STIR = np.uint64(shared.BASE)


class Vocabulary:
    """Token bytes with ranks, and for each token the two it was merged from."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            self.rank = {base64.b64decode(a): int(b) for a, b in pairs}
        self.longest = max(map(len, self.rank))
        self.bytes = {i: t for t, i in self.rank.items()}
        self._parts: dict[bytes, tuple[bytes, bytes] | None] = {}
        self._fits: dict[tuple[bytes, bytes], bool] = {}

    def parts(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The last merge that makes ``token``; None for one that no merge makes."""
        if token not in self._parts:
            merged = self._merged(token, self.rank[token])
            self._parts[token] = (merged[0], merged[1]) if len(merged) == 2 else None
        return self._parts[token]

    def _merged(self, data: bytes, below: int) -> list[bytes]:
        """``data`` merged pair by pair, lowest rank and leftmost first, up to a rank."""
        tokens = [data[i : i + 1] for i in range(len(data))]
        while len(tokens) > 1:
            ranks = [self.rank.get(a + b, below) for a, b in zip(tokens, tokens[1:])]
            least = min(ranks)
            if least >= below:
                break
            i = ranks.index(least)
            tokens[i : i + 2] = [tokens[i] + tokens[i + 1]]
        return tokens

    def fits(self, left: bytes, right: bytes) -> bool:
        """Whether merging ``left + right`` ends at these two tokens.

        They are taken apart merge by merge, the later merge first. If two parts that touch
        the border would have been merged before the merge that was just undone, the border
        would not have survived.
        """
        key = (left, right)
        if key not in self._fits:
            if len(self._fits) > 500_000:
                self._fits.clear()
            self._fits[key] = self._border_stays(left, right)
        return self._fits[key]

    def _border_stays(self, left: bytes, right: bytes) -> bool:
        limit = len(self.rank) << 1
        while True:
            across = self.rank.get(left + right)
            if across is not None and across < limit:
                return False
            a, b = self.rank[left], self.rank[right]
            if a > b:
                parts = self.parts(left)
                if parts is None:
                    if (parts := self.parts(right)) is None:
                        return True
                    limit, right = b, parts[0]
                else:
                    # the left neighbour's merge, undone; equal ranks merge leftmost first
                    limit, left = a, parts[1]
            else:
                parts = self.parts(right)
                if parts is None:
                    if (parts := self.parts(left)) is None:
                        return True
                    limit, left = a, parts[1]
                else:
                    limit, right = b + 1, parts[0]


class Prefixes:
    """For each prefix of some bytes, the last token of its encoding.

    Each prefix has one valid encoding, and it is that of a shorter prefix plus one token:
    the only token that fits what the shorter prefix ends with. So ``last`` grows byte by
    byte, ``append`` is exact, and after an edit only what follows the first changed byte is
    worked out anew.
    """

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self._vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, more: bytes) -> Prefixes:
        rank, fits, longest = self._vocabulary.rank, self._vocabulary.fits, self._vocabulary.longest
        start = len(self.data)
        data = self.data = self.data + more
        last = self.last
        for end in range(start + 1, len(data) + 1):
            for begin in range(max(0, end - longest), end):
                token = data[begin:end]
                if token in rank and (not begin or fits(last[begin - 1], token)):
                    last.append(token)
                    break
        return self

    def edit(self, begin: int, end: int, by: bytes) -> Prefixes:
        """Put ``by`` in place of the bytes begin .. end - 1."""
        rest = self.data[end:]
        self.data, self.last = self.data[:begin], self.last[:begin]
        return self.append(by + rest)

    def tokens(self) -> list[bytes]:
        found, end = [], len(self.data)
        while end:
            found.append(self.last[end - 1])
            end -= len(found[-1])
        return found[::-1]

    def ids(self) -> list[int]:
        return [self._vocabulary.rank[t] for t in self.tokens()]


class _Table:
    """Numbers of byte strings by their substring hash, for whole arrays at a time."""

    _BITS = 19

    def __init__(self, tokens: dict[bytes, int]):
        joined = np.frombuffer(b"".join(tokens), np.uint8)
        ends = np.cumsum([len(t) for t in tokens])
        starts = np.r_[0, ends[:-1]]
        hashes = shared.substring_hashes(shared.prefix_hashes(joined), starts, ends)
        numbers = np.fromiter(tokens.values(), np.int64, len(tokens))
        slots = self._slot(hashes)
        self._hash = np.zeros(1 << self._BITS, np.uint64)
        self._number = np.full(1 << self._BITS, -1, np.int32)
        first = np.unique(slots, return_index=True)[1]
        self._hash[slots[first]], self._number[slots[first]] = hashes[first], numbers[first]
        rest = np.delete(np.arange(len(slots)), first)
        rest = rest[np.argsort(hashes[rest])]
        self._crowded = np.zeros(1 << self._BITS, bool)
        self._crowded[slots[rest]] = True
        self._rest, self._rest_number = hashes[rest], numbers[rest]
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two tokens share a hash")

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self._BITS)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        slots = self._slot(hashes)
        found = np.where(self._hash[slots] == hashes, self._number[slots], -1)
        again = np.flatnonzero(self._crowded[slots] & (found < 0))
        if len(again):
            at = np.minimum(np.searchsorted(self._rest, hashes[again]), len(self._rest) - 1)
            found[again] = np.where(self._rest[at] == hashes[again], self._rest_number[at], -1)
        return found


class Words:
    """The same prefix tables for many short words at once.

    Prefix length by prefix length, and for each from the longest token down, all words look
    their next token up together; a word is settled at the first that fits its prefix. A
    token found by hash is compared by its bytes when the ids are read back.
    """

    #: Longer words go through Prefixes one by one.
    LONGEST = 40
    #: Answers of ``fits`` that are kept, as a power of two.
    _PAIR_BITS = 20
    _BLOCK = 1 << 18

    def __init__(self, vocabulary: Vocabulary):
        self._vocabulary = vocabulary
        self._table = _Table(vocabulary.rank)
        self._pair = np.full(1 << self._PAIR_BITS, -1, np.int64)
        self._pair_fits = np.zeros(1 << self._PAIR_BITS, bool)
        listed = [vocabulary.bytes.get(i, b"") for i in range(max(vocabulary.bytes) + 1)]
        self.size = np.array([len(t) for t in listed])
        self.places = np.r_[0, np.cumsum(self.size)]
        self.joined = np.frombuffer(b"".join(listed), np.uint8)

    def _fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left << 32) | right
        slots = ((keys.astype(np.uint64) * _STIR) >> np.uint64(64 - self._PAIR_BITS)).astype(np.int64)
        fits = self._pair_fits[slots]
        new = np.flatnonzero(self._pair[slots] != keys)
        if len(new):
            told, at = np.unique(keys[new], return_inverse=True)
            tokens, decide = self._vocabulary.bytes, self._vocabulary.fits
            found = [decide(tokens[k >> 32], tokens[k & 0xFFFFFFFF]) for k in told.tolist()]
            fits[new] = np.array(found, bool)[at]
            # of pairs with the same slot one stays, with its own answer
            self._pair[slots[new]] = keys[new]
            self._pair_fits[slots[new]] = fits[new]
        return fits

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the ids, a block at a time, as numbers for each byte take far more than it."""
        blocks = (ids[low : low + self._BLOCK] for low in range(0, len(ids), self._BLOCK))
        return b"".join(
            gathered(self.joined, self.places[some], self.size[some]).tobytes() for some in blocks
        )

    def spell(
        self, ids: np.ndarray, counts: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray
    ) -> bool:
        """Whether each word, ``counts`` ids long, has the bytes between its start and end."""
        reach = np.r_[0, np.cumsum(self.size[ids])][np.r_[0, np.cumsum(counts)]]
        sizes = ends - starts
        return np.array_equal(np.diff(reach), sizes) and self.decode(ids) == gathered(
            data, starts, sizes
        ).tobytes()

    def encode(
        self, data: np.ndarray, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words end to end, and how many each has. Words lie apart in ``data``,
        of which ``sums`` are the prefix hashes."""
        sizes = ends - starts
        order = np.argsort(-sizes, kind="stable")
        long = int(np.count_nonzero(sizes > self.LONGEST))
        ids, some = self._short(data, sums, starts[order[long:]], sizes[order[long:]])
        if not self.spell(ids, some, data, starts[order[long:]], ends[order[long:]]):
            long, ids, some = len(order), ids[:0], some[:0]  # a hash that two strings share
        rest = [
            np.array(Prefixes(self._vocabulary, data[starts[k] : ends[k]].tobytes()).ids(), np.uint32)
            for k in order[:long]
        ]
        ids = np.concatenate([*rest, ids])
        counts = np.r_[np.array([len(x) for x in rest], np.int64), some]
        first = np.cumsum(counts) - counts
        back = np.argsort(order)
        return gathered(ids, first[back], counts[back]), counts[back]

    def _short(
        self, data: np.ndarray, sums: np.ndarray, starts: np.ndarray, sizes: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Of words sorted from long to short."""
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        last = np.full(len(data), -1, np.int64)
        for end in range(1, int(sizes[0]) + 1):
            open_ = starts[: np.searchsorted(-sizes, -end, side="right")]
            for length in range(min(end, self._vocabulary.longest), 0, -1):
                stop = open_ + end
                token = self._table.find(shared.substring_hashes(sums, stop - length, stop))
                some = np.flatnonzero(token >= 0)
                if length < end and len(some):
                    fits = self._fits(last[stop[some] - length - 1], token[some])
                    some = some[fits]
                if len(some):
                    last[stop[some] - 1] = token[some]
                    open_ = np.delete(open_, some)
                    if not len(open_):
                        break
        # read back from the end, all words together
        place, counts = starts + sizes, np.zeros(len(starts), np.int64)
        steps = []
        live = np.arange(len(starts))
        while len(live):
            token = last[place[live] - 1]
            steps.append((live, token))
            counts[live] += 1
            place[live] -= self.size[token]
            live = live[place[live] > starts[live]]
        ends = np.cumsum(counts)
        ids = np.empty(ends[-1], np.uint32)
        for k, (at, token) in enumerate(steps):
            ids[ends[at] - 1 - k] = token
        return ids, counts


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(2)
def _words(path: str) -> Words:
    return Words(vocabulary(path))


@lru_cache(2)
def _pieces(path: str, pattern: str) -> Pieces:
    return Pieces(_words(path), pattern)


def encode_decode(
    docs: DataFrame,
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    columns: list[str] | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """``columns`` of docs (doc_id by default), n_tokens, ids_sha256, decoded_sha256.

    Each match of ``pattern`` in the whole text is encoded by itself. The ids, little-endian
    unsigned 32-bit numbers, are decoded again by their bytes; ``with_ids`` adds them and
    the decoded bytes. A null or empty text has no ids; every row gives one row.
    """
    kept = columns or ["doc_id"]
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = docs.select(*[docs[c].alias(f"k{i}") for i, c in enumerate(kept)], "text")
    schema = T.StructType(rows.drop("text").schema.fields).add("n_tokens", "long")
    schema = schema.add("ids_sha256", "string").add("decoded_sha256", "string")
    if with_ids:
        schema = schema.add("ids", "binary").add("decoded", "binary")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(path)
        for batch in shared.text_slices(batches, "text"):
            numbers, places = _pieces(path, pattern).encode(batch.column("text"))
            reach = np.r_[0, np.cumsum(words.size[numbers])][places].tolist()
            raw, spelt, at = numbers.astype("<u4").tobytes(), words.decode(numbers), places.tolist()
            ids = [raw[4 * a : 4 * b] for a, b in pairwise(at)]
            back = [spelt[a:b] for a, b in pairwise(reach)]
            columns = [
                *batch.columns[:-1],
                pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                pa.array([hashlib.sha256(x).hexdigest() for x in back], pa.string()),
            ]
            if with_ids:
                columns.extend([pa.array(ids, pa.binary()), pa.array(back, pa.binary())])
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    coded = shared.mapped(rows, work, schema)
    return coded.withColumnsRenamed({f"k{i}": c for i, c in enumerate(kept)})

"""Texts cut into pieces that a byte-level tokenizer treats separately, with a memory of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex

from shiftpay.llm import shared

#: Bytes of remembered matches and ids at most, in the memory of a worker.
MEMORY_BYTES = 64 << 20
#: Bytes that an entry takes beside its ids, twice as it is copied when others come.
ENTRY_BYTES = 32
#: Longer matches, in bytes, are encoded each time, so that few of them can't fill the memory.
LONGEST = 64

_LETTER, _DIGIT, _MARK, _SPACE, _UNSURE = range(5)


def _kinds() -> np.ndarray:
    kind = np.full(256, _UNSURE, np.uint8)
    for b in range(33, 127):
        kind[b] = _LETTER if chr(b).isalpha() else _DIGIT if chr(b).isdigit() else _MARK
    kind[[9, 10, 11, 12, 13, 32]] = _SPACE
    return kind


#: Of ASCII bytes; what the pattern takes control characters for is left to it.
_KIND = _kinds()
#: Which code points of two or three bytes are letters, as the pattern has it.
_IS_LETTER = np.zeros(1 << 16, bool)
_WIDE = "".join(map(chr, [*range(0x80, 0xD800), *range(0xE000, 1 << 16)]))
_IS_LETTER[[ord(c) for c in regex.findall(r"\p{L}", _WIDE)]] = True
#: First bytes of characters that may be white space outside ASCII.
_MAYBE_SPACE = (0xC2, 0xE1, 0xE2, 0xE3)


def gathered(values: np.ndarray, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``counts`` values from each ``first`` place on, end to end."""
    return values[np.repeat(first, counts) + shared.ranges(counts)]


class Memory:
    """Ids of strings by their 64-bit hash, which may mislead: who asks compares the bytes.

    It forgets all rather than hold more than MEMORY_BYTES.
    """

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.bytes = 0
        self._hash = np.zeros(0, np.uint64)
        self._first = np.zeros(0, np.int64)
        self._places = np.zeros(1, np.int64)
        self._ids = np.zeros(0, np.uint32)

    def __iter__(self) -> Iterator[np.ndarray]:
        return iter(np.split(self._ids, self._places[1:-1]) if len(self._hash) else [])

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the strings end to end, and how many each has: none if it is not known."""
        counts = np.zeros(len(hashes), np.int64)
        if not len(self._hash):
            return self._ids, counts
        at = np.minimum(np.searchsorted(self._hash, hashes), len(self._hash) - 1)
        known = np.flatnonzero(self._hash[at] == hashes)
        entry = self._first[at[known]]
        first = self._places[entry]
        counts[known] = self._places[entry + 1] - first
        return gathered(self._ids, first, counts[known]), counts

    def learn(self, hashes: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Adds strings that it does not know."""
        more = ENTRY_BYTES * len(hashes) + 4 * len(ids)
        if self.bytes + more > MEMORY_BYTES:
            self.clear()
        if more > MEMORY_BYTES:
            return
        order = np.argsort(hashes)
        at = np.searchsorted(self._hash, hashes[order])
        self._first = np.insert(self._first, at, len(self._hash) + order)
        self._hash = np.insert(self._hash, at, hashes[order])
        self._places = np.concatenate([self._places, len(self._ids) + np.cumsum(counts)])
        self._ids = np.concatenate([self._ids, ids.astype(np.uint32)])
        self.bytes += more


class Pieces:
    """Ids of texts, match by match of a pattern.

    Texts are cut where PATTERN surely ends a match; with another pattern they stay whole.
    Most pieces then are one match, the others are matched one by one. Ids of matches are
    looked up, those of new ones worked out by ``words``, all at once.
    """

    def __init__(self, words, pattern: str):
        self._words, self._split = words, regex.compile(pattern)
        self._usual = pattern == public_tokenizers.PATTERN
        self._known = Memory()

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        ids, places = self.encode(pa.array(texts, pa.string()))
        return [x.astype("<u4").tobytes() for x in np.split(ids, places[1:-1])] if texts else []

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the n + 1 places where each text's begin and end."""
        data, places = shared.raw_bytes(texts)
        kind = kinds(data)
        cut = cuts(data, kind, places) if self._usual else np.zeros(len(data) + 1, bool)
        cut[places] = True
        at = np.flatnonzero(cut)
        pieces = _binary(data, at).dictionary_encode()
        ids, first, counts = self._pieces(pieces.dictionary)
        entry = pieces.indices.to_numpy()
        counts = counts[entry]
        ids = gathered(ids, first[entry], counts)
        return ids, np.r_[0, np.cumsum(counts)][np.searchsorted(at, places)]

    def _pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where each piece's begin and how many they are."""
        data, places = shared.raw_bytes(pieces)
        one = single(data, places) if self._usual else np.zeros(len(pieces), bool)
        alone, rest = np.flatnonzero(one), np.flatnonzero(~one)
        found = [self._split.findall(p.decode()) for p in pieces.take(pa.array(rest)).to_pylist()]
        matches = pa.array([m.encode() for some in found for m in some if m], pa.binary())
        ids, counts = self._matches(pa.concat_arrays([pieces.take(pa.array(alone)), matches]))
        reach = np.r_[0, np.cumsum(counts)]
        ends = np.cumsum([sum(map(bool, some)) for some in found], dtype=np.int64)
        borders = reach[np.r_[np.arange(len(alone) + 1), len(alone) + ends]]
        first, sizes = np.empty((2, len(pieces)), np.int64)
        order = np.r_[alone, rest]
        first[order], sizes[order] = borders[:-1], np.diff(borders)
        return ids, first, sizes

    def _matches(self, matches: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the matches end to end, and how many each has."""
        told = matches.dictionary_encode()
        data, places = shared.raw_bytes(told.dictionary)
        starts, ends = places[:-1], places[1:]
        sums = shared.prefix_hashes(data)
        hashes = shared.substring_hashes(sums, starts, ends)
        old, counts = self._known.find(hashes)
        known = counts > 0
        if not self._words.spell(old, counts[known], data, starts[known], ends[known]):
            # a hash that two strings share: nothing is taken from the memory
            self._known.clear()
            old, counts = old[:0], np.zeros_like(counts)
            known = counts > 0
        new, counts[~known] = self._words.encode(data, sums, starts[~known], ends[~known])
        short = ~known & (ends - starts <= LONGEST)
        kept = np.repeat(short[~known], counts[~known])
        self._known.learn(hashes[short], new[kept], counts[short])
        ids = np.concatenate([old, new])
        first = np.empty(len(counts), np.int64)
        order = np.r_[np.flatnonzero(known), np.flatnonzero(~known)]
        first[order] = np.cumsum(counts[order]) - counts[order]
        entry = told.indices.to_numpy()
        return gathered(ids, first[entry], counts[entry]), counts[entry]


def _binary(data: np.ndarray, at: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(at.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())]
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, buffers)


def kinds(data: np.ndarray) -> np.ndarray:
    """What each byte belongs to, with the bytes of letters outside ASCII among letters."""
    kind = _KIND[data]
    for low, high, more in ((0xC2, 0xDF, 1), (0xE0, 0xEF, 2)):
        lead = np.flatnonzero((data >= low) & (data <= high))
        code = data[lead].astype(np.int64) & (0x1F if more == 1 else 0x0F)
        for k in range(1, more + 1):
            code = (code << 6) | (data[lead + k] & 0x3F)
        lead = lead[_IS_LETTER[code]]
        for k in range(more + 1):
            kind[lead + k] = _LETTER
    return kind


def cuts(data: np.ndarray, kind: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Places where PATTERN ends a match whatever stands around them, texts' ends apart.

    No match holds two kinds, but for a space ahead and an apostrophe ahead of letters. The
    last space before anything but white space opens a match. Other white space between two
    others is a match by itself; in longer runs it depends on the rest of the run.
    """
    cut = np.zeros(len(data) + 1, bool)
    if len(data) < 2:
        return cut
    before, after = kind[:-1], kind[1:]
    solid = kind < _SPACE
    ends = solid[:-1] & (before != after) & (after != _UNSURE)
    ends &= (data[:-1] != 39) | (after != _LETTER)
    lone = (before == _SPACE) & (data[:-1] != 32) & solid[1:]
    lone[0] = False
    lone[1:] &= solid[:-2]
    cut[1:-1] = ends | lone
    opens = (data[:-1] == 32) & (data[1:] > 32)
    for lead in _MAYBE_SPACE:
        opens &= data[1:] != lead
    last = places[1:] - 1
    last = last[(last >= 0) & (last < len(opens))]
    opens[last] = False  # what follows is another text
    cut[:-2] |= opens
    return cut


def single(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Which pieces, none empty, surely are one match: one kind, maybe a space ahead."""
    if not len(data):
        return np.zeros(0, bool)
    kind = kinds(data)
    starts, ends = places[:-1], places[1:]
    spaced = (data[starts] == 32) & (ends - starts > 1)
    body = starts + spaced
    kind[starts[spaced]] = kind[body[spaced]]
    least, most = np.minimum.reduceat(kind, starts), np.maximum.reduceat(kind, starts)
    return (least == most) & (most < _SPACE)

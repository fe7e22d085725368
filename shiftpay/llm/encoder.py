"""Ids of whole texts as the tokenizers library gives them, by looking repeated words up.

Encoding a text in the library costs far more than finding its words. So a slice of texts is
cut, by Arrow, at places where the file's rules can't join two tokens; each distinct piece is
encoded once, or looked up in a memory bounded by bytes; the ids are put together by numpy.
Where a file's normalizer, pre-tokenizer, added tokens or model are not of a form for which
that is known to be right, whole texts go to the library.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from shiftpay.llm import shared

#: Bytes of the pieces and ids that a worker remembers, and what each entry costs beside them.
MEMORY_BYTES = 64 << 20
ENTRY_BYTES = 200
#: Longer pieces go to the library each time, so that few of them can't fill the memory.
REMEMBERED = 64
#: First bytes, in UTF-8, of characters that may be white space outside ASCII.
_MAYBE_SPACE = (0xC2, 0xE1, 0xE2, 0xE3)
#: Added to the last letter of a word, in the alphabet that merging by ranks uses.
_LAST = 0x200

#: The rules of the two kinds of files that are known.
_PIECE_RULES = {
    "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True,
}
_WORD_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORD_NORMAL = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
_WORD_RULES = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": _WORD_RULE}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
_WORD_END = "</w>"


#: Words that neither NFC nor the rule's contractions change, and that lower case changes
#: letter by letter: printable ASCII but the apostrophe, and the Latin letters after it.
_SIMPLE = re.compile("[!-&(-~À-ÖØ-öø-ÿ]{1,%d}" % REMEMBERED).fullmatch


def byte_letters() -> dict[str, int]:
    """The byte that each letter of the byte-level alphabet stands for."""
    plain = [i for i in range(256) if chr(i).isprintable() and i not in (32, 160, 173)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


_LETTER = np.zeros(256, np.uint32)
for _c, _b in byte_letters().items():
    _LETTER[_b] = ord(_c)
#: By Latin-1 number: the lower-case letter; 1 for letters, 2 for digits, 3 for other marks.
_LOWER = np.array([ord(chr(b).lower()) if chr(b).lower().isascii() or b >= 192 else b for b in range(256)], np.uint8)
_KIND = np.array(
    [0 if b == 10 else 1 if chr(b).isalpha() else 2 if 48 <= b < 58 else 3 for b in range(256)], np.uint8
)


class Encoder:
    """Ids by the file ``path``, without special tokens added around a text.

    Strings of added tokens within a text get the added token's id, as in the library.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        self._library = Tokenizer.from_file(path)
        model, added = rules["model"], rules["added_tokens"]
        self._added = [t["content"] for t in added]
        shape = (rules["normalizer"], rules["pre_tokenizer"], rules["post_processor"] or None)
        usual = (
            model.get("type", "BPE") == "BPE"
            and not any(model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges", "unk_token"))
            and not model.get("continuing_subword_prefix")
            and not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
        )
        self._kind, self._ranks = "", None
        if usual and shape == (None, _PIECE_RULES, None) and not model.get("end_of_word_suffix"):
            self._kind = "pieces"
        elif usual and shape == (_WORD_NORMAL, _WORD_RULES, None):
            self._kind = "words" if model.get("end_of_word_suffix") == _WORD_END else ""
        if self._kind:
            self._ranks = self._ranked(model)
        self._forget()

    def _forget(self) -> None:
        self._entry: dict[str, int] = {}
        self._ids, self._firsts = _Grown(np.uint32), _Grown(np.int64)
        self._firsts.add(np.zeros(1, np.int64))
        self._bytes = 0

    def _ranked(self, model: dict) -> tiktoken.Encoding | None:
        """The merges as ranks, if the file numbers its tokens in the order of its merges.

        Merging by ranks gives the same ids in a fraction of the time. Where words end in
        letters of their own, those are letters further up; letters of two bytes have the
        lowest ranks, so each is put together before anything else.
        """
        ids = {t: i for t, i in model["vocab"].items() if t not in self._added}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [ids.get(a + b, -1) for a, b in merges]
        letter = byte_letters()
        ends = (_WORD_END,) if self._kind == "words" else ()
        single = [c + end for end in ("", *ends) for c in letter]
        if any(x >= y for x, y in zip(made, made[1:])) or {*single} | {a + b for a, b in merges} != {*ids}:
            return None
        if self._kind == "pieces":
            ranks = {bytes(map(letter.__getitem__, t)): i for t, i in ids.items()}
            self._id_of = np.arange(max(ranks.values()) + 1, dtype=np.uint32)
            pattern = public_tokenizers.PATTERN
        else:
            bodies = {t: t.removesuffix(_WORD_END) for t in ids}
            spelt = {
                t: (b if b == t else b[:-1] + chr(ord(b[-1]) + _LAST)).encode() for t, b in bodies.items()
            }
            first = sorted(single, key=lambda t: -len(spelt[t]))
            order = first + [a + b for a, b in merges]
            ranks = {spelt[t]: k for k, t in enumerate(order)}
            self._id_of = np.array([ids[t] for t in order], np.uint32)
            pattern = r"[^\n]+"
        self._length = np.zeros(len(self._id_of), np.int64)
        for token, k in ranks.items():
            self._length[k] = len(token)
        return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and the n + 1 places where each text's begin and
        end. A null text is empty."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        whole = np.full(len(texts), not self._kind)
        for content in self._added:
            # an added token ends what stands before it, white space included
            whole |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        if not whole.any():
            return self._by_pieces(texts)
        some, rest = np.flatnonzero(~whole), np.flatnonzero(whole)
        ids, places = self._by_pieces(texts.take(pa.array(some)))
        found = dict(zip(some.tolist(), np.split(ids, places[1:-1])))
        found |= zip(rest.tolist(), self._plain(texts.take(pa.array(rest)).to_pylist()))
        return _joined([found[k] for k in range(len(texts))])

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        found = self._library.encode_batch(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in found]

    def _by_pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        pieces, before = _words(texts) if self._kind == "words" else _pieces(texts)
        told = pieces.dictionary_encode()
        entry = self._look_up(told.dictionary.to_pylist())[told.indices.to_numpy()]
        firsts = self._firsts.get()
        counts = firsts[entry + 1] - firsts[entry]
        ids = self._ids.get()[np.repeat(firsts[entry], counts) + shared.ranges(counts)]
        return ids, np.r_[0, np.cumsum(counts)][before]

    def _look_up(self, pieces: list[str]) -> np.ndarray:
        """Entries of the memory, with new pieces added to it."""
        if self._bytes > MEMORY_BYTES:
            self._forget()
        entry = np.fromiter((self._entry.get(p, -1) for p in pieces), np.int64, len(pieces))
        missing = np.flatnonzero(entry < 0)
        new = [pieces[k] for k in missing.tolist()]
        ids, places = self._encode(new)
        first = self._firsts.size - 1
        entry[missing] = first + np.arange(len(new))
        self._firsts.add(self._ids.size + places[1:])
        self._ids.add(ids)
        self._entry.update((p, first + k) for k, p in enumerate(new) if len(p) <= REMEMBERED)
        self._bytes += 4 * len(ids) + 4 * sum(map(len, new)) + ENTRY_BYTES * len(new)
        return entry

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each piece, those that suit it merged by ranks and all at once."""
        if self._ranks is None:
            return _joined(self._plain(pieces))
        suits = self._plain_word if self._kind == "words" else self._spaced
        several = np.fromiter(map(suits, pieces), bool, len(pieces))
        some, rest = np.flatnonzero(several), np.flatnonzero(~several)
        merge = self._merged_words if self._kind == "words" else self._merged_pieces
        ids, places = merge([pieces[k] for k in some.tolist()])
        others, other_places = _joined(self._plain([pieces[k] for k in rest.tolist()]))
        order = np.empty(len(pieces), np.int64)
        order[np.r_[some, rest]] = np.arange(len(pieces))
        begin = np.r_[places[:-1], len(ids) + other_places[:-1]][order]
        counts = np.r_[np.diff(places), np.diff(other_places)][order]
        ids = np.concatenate([ids, others])[np.repeat(begin, counts) + shared.ranges(counts)]
        return ids, np.r_[0, np.cumsum(counts)]

    @staticmethod
    def _spaced(piece: str) -> bool:
        """Whether a match opens with the piece wherever it stands."""
        return piece[:1] == " " and piece[1:2].isalnum() and len(piece) <= REMEMBERED

    def _merged_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ends = np.cumsum([len(p.encode()) for p in pieces], dtype=np.int64)
        return self._merged("".join(pieces), np.r_[0, ends])

    @staticmethod
    def _plain_word(word: str) -> bool:
        return _SIMPLE(word) is not None

    def _merged_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words of _SIMPLE: runs of letters, single digits, runs of other marks."""
        data = _LOWER[np.frombuffer("\n".join([*words, ""]).encode("latin-1"), np.uint8)]
        kind = _KIND[data]
        last = (kind > 0) & ((kind != np.r_[kind[1:], 0]) | (kind == 2))
        wide = data >= 0xC0  # two bytes in UTF-8, and so two letters
        counts = np.sum([kind > 0, wide, last], axis=0)  # the last letter of a run ends the line
        at = np.cumsum(counts) - counts
        out = np.full(int(counts.sum()), 10, np.uint32)
        out[at[wide]] = _LETTER[0xC3]
        body = kind > 0
        low = np.where(wide, 0x80 | data & 0x3F, data)[body]
        out[(at + wide)[body]] = _LETTER[low] + np.where(last[body], _LAST, 0)
        size = np.r_[0, np.cumsum(np.where(out == 10, 0, np.where(out < 0x80, 1, 2)))]  # bytes before each letter
        ends = size[at[kind == 0]]
        return self._merged(out.astype("<u4").tobytes().decode("utf-32-le"), np.r_[0, ends])

    def _merged(self, text: str, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a text, and the number of them before each end, which are in bytes."""
        ranks = np.array(self._ranks.encode_ordinary(text), np.int64)
        after = np.cumsum(self._length[ranks])
        return self._id_of[ranks], np.searchsorted(after, ends, "right")


class _Grown:
    """An array that grows at its end."""

    def __init__(self, kind):
        self._room, self.size = np.empty(1024, kind), 0

    def add(self, values: np.ndarray) -> None:
        if self.size + len(values) > len(self._room):
            room = np.empty(2 * (self.size + len(values)), self._room.dtype)
            room[: self.size] = self._room[: self.size]
            self._room = room
        self._room[self.size : self.size + len(values)] = values
        self.size += len(values)

    def get(self) -> np.ndarray:
        return self._room[: self.size]


def _joined(found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    return np.concatenate([np.zeros(0, np.uint32), *found]), np.r_[0, np.cumsum(sizes)]


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words between ASCII white space, which the normalizer and the rule drop; the number
    of words before each text."""
    lists = pc.ascii_split_whitespace(texts)
    return lists.flatten(), np.r_[0, np.cumsum(pc.list_value_length(lists).to_numpy())]


def _pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Texts cut before each space that no white space follows: one always opens a match."""
    data, places = shared.raw_bytes(texts)
    cut = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        after = data[1:]
        opens = (data[:-1] == 32) & (after > 32)
        for lead in _MAYBE_SPACE:
            opens &= after != lead
        cut[:-2] = opens
    cut[places] = True
    at = np.flatnonzero(cut)
    pieces = pa.StringArray.from_buffers(
        len(at) - 1, pa.py_buffer(at.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())
    )
    return pieces, np.searchsorted(at, places)


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from shiftpay.llm import bpe, packing, pieces as piece_memory

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [
    "a", "b", "é", "ß", " ", "  ", "\n", "\t", "\r\n", "\x1c", "\x85", "\xa0", "'s", "'LL", "1", "²",
    "٣", "_", "-", "!!", "日本", "🙂", "\x00", "the", " the", "<|endoftext|>", " ing", "aaaa", "Ⅷ",
]


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(JSON)


def texts(n: int) -> list[str]:
    draw = random.Random(4)
    return ["".join(draw.choices(PARTS, k=draw.randint(0, 25))) for _ in range(n)] + ["x" * 5000, ""]


def plain(raw: bytes) -> list[int]:
    return np.frombuffer(raw, "<u4").tolist()


def test_ids_equal_the_library(library):
    some = texts(1500)
    own = bpe._pieces(RANKS, public_tokenizers.PATTERN).ids(some)
    for text, a in zip(some, own):
        assert plain(a) == library.encode_ordinary(text)


def test_memory_of_pieces_is_bounded_by_bytes(library, monkeypatch):
    monkeypatch.setattr(piece_memory, "MEMORY_BYTES", 20_000)
    draw = random.Random(6)
    own = bpe._pieces.__wrapped__(RANKS, public_tokenizers.PATTERN)
    for _ in range(20):
        some = ["".join(draw.choices("日本語テキスト", k=k)) for k in (3, 40, 64, 65, 3000)]
        some += [" ".join("".join(draw.choices("abcdef", k=6)) for _ in range(20)), *some[:2], "", " "]
        for text, a in zip(some, own.ids(some)):
            assert plain(a) == library.encode_ordinary(text)
        assert own._known.bytes <= 20_000
        assert all(len(p) <= piece_memory.LONGEST for p in own._known)


def test_more_than_the_memory_in_one_go(library, monkeypatch):
    monkeypatch.setattr(piece_memory, "MEMORY_BYTES", 100)
    own = bpe._pieces.__wrapped__(RANKS, public_tokenizers.PATTERN)
    some = [f"word{k} of {k * 7919}" for k in range(50)]
    for _ in range(2):
        assert [plain(a) for a in own.ids(some)] == [library.encode_ordinary(t) for t in some]


def test_matches_at_every_border(library):
    draw = random.Random(7)
    parts = [
        " ", " ", "\n", "\t", "\x0b", "\x1c", "\x1f", "\x7f", "\x85", "\xa0", "\u2003", "\u3000", "'", "'s", "'LL", "’",
        "a", "Z", "été", "É", "×", "÷", "ª", "ÿ", "ā", "e\u0301", "ж", "7", "²", "٣", "_", "—", "-", ",", "...", "日",
    ]
    own = bpe._pieces.__wrapped__(RANKS, public_tokenizers.PATTERN)
    for _ in range(30):
        some = ["".join(draw.choices(parts, k=draw.randint(0, 9))) for _ in range(400)]
        assert [plain(a) for a in own.ids(some)] == [library.encode_ordinary(t) for t in some]
    # each text ends where it ends, whatever the next one opens with
    some = ["end  ", "next", "end \n", "'s", "end ", ",", "\n", "x", "", " ", "y"]
    assert [plain(a) for a in own.ids(some)] == [library.encode_ordinary(t) for t in some]


def looked_up(monkeypatch) -> list[int]:
    """How many strings the table of tokens is asked for, call by call."""
    asked, find = [], bpe._Table.find
    monkeypatch.setattr(bpe._Table, "find", lambda self, h: asked.append(len(h)) or find(self, h))
    return asked


def test_words_of_a_small_memory_are_worked_out_once(library, monkeypatch):
    monkeypatch.setattr(piece_memory, "MEMORY_BYTES", 100_000)
    draw = random.Random(8)
    words = ["".join(draw.choices("abcdefghé", k=8)) for _ in range(1000)]
    own = bpe._pieces.__wrapped__(RANKS, public_tokenizers.PATTERN)
    asked = looked_up(monkeypatch)
    own.ids([f"so {w} it" for w in words])
    assert asked
    asked.clear()
    # the same words, with other marks after them
    some = [f"so {w}{m} it" for w in words for m in ("", " so", "\nso")]
    found = own.ids(some)
    assert sum(asked) < 100
    assert [plain(a) for a in found] == [library.encode_ordinary(t) for t in some]


def test_strings_that_share_a_hash_are_told_apart(library):
    own = bpe._pieces.__wrapped__(RANKS, public_tokenizers.PATTERN)
    own.ids(["one two three", "four"])
    own._known._first = own._known._first[::-1].copy()
    some = ["four three", "one two", " two"]
    assert [plain(a) for a in own.ids(some)] == [library.encode_ordinary(t) for t in some]


@pytest.mark.parametrize("pattern", [r"\w+| |[^\w ]", r"[a-z ]+(?= )|[\s\S]"])
def test_other_patterns(pattern):
    own = bpe._pieces.__wrapped__(RANKS, pattern)
    some = ["two words, and  more\n", "", "next one ", " x"]
    vocabulary = bpe.vocabulary(RANKS)
    for text, a in zip(some, own.ids(some)):
        matches = re.findall(pattern, text)
        assert plain(a) == [i for m in matches for i in bpe.Prefixes(vocabulary, m.encode()).ids()]


def test_appends_and_edits_equal_encoding_anew():
    draw = random.Random(5)
    vocabulary = bpe.vocabulary(RANKS)
    for _ in range(300):
        data = "".join(draw.choices("abethrin", k=draw.randint(0, 30))).encode()
        more = "".join(draw.choices("abethrin", k=draw.randint(0, 6))).encode()
        grown = bpe.Prefixes(vocabulary, data).append(more)
        assert grown.ids() == bpe.Prefixes(vocabulary, data + more).ids()
        a, b = sorted(draw.choices(range(len(data) + 1), k=2))
        edited = bpe.Prefixes(vocabulary, data).edit(a, b, more)
        assert edited.data == data[:a] + more + data[b:]
        assert edited.ids() == bpe.Prefixes(vocabulary, edited.data).ids()


ROWS = [(i, t, 7, "c") for i, t in enumerate(texts(60))] + [
    (None, "no id", 1, "c"), (5, None, 1, None), (5, "twice", 1, "c"), (5, "twice", 1, "c"),
]
SCHEMA = "doc_id long, text string, start int, ids string"


def test_encode_decode(spark, library):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    found = bpe.encode_decode(docs, with_ids=True).collect()
    expected = []
    for i, text, *_ in ROWS:
        ids = library.encode_ordinary(text or "")
        raw = np.array(ids, "<u4").tobytes()
        body = (text or "").encode()
        digests = [hashlib.sha256(x).hexdigest() for x in (raw, body)]
        expected.append((i, len(ids), *digests, raw, body))
    assert sorted(map(repr, expected)) == sorted(
        repr((*r[:4], bytes(r[4]), bytes(r[5]))) for r in found
    )


@pytest.mark.parametrize("window", [16, 2048])
def test_packing_round_trip(spark, tokenizer, window):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    pieces = packing.pack(docs, window=window, with_ids=True).collect()
    sequences: dict[int, list] = {}
    for p in pieces:
        assert p.length == len(p.ids) // 4 > 0
        assert p.ids_crc32 == zlib.crc32(bytes(p.ids))
        sequences.setdefault(p.sequence_id, []).append(p)
    assert sorted(sequences) == list(range(len(sequences)))
    for number, some in sequences.items():
        at = 0
        for p in sorted(some, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == window or number == len(sequences) - 1 and at <= window
    documents, current = [], []
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.start == len(current)
        current += plain(bytes(p.ids))
        if len(current) == p.doc_tokens:
            documents.append((p.doc_id, current))
            current = []
    assert not current
    expected = [
        (i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for i, t, *_ in ROWS
    ]
    assert sorted(map(repr, documents)) == sorted(map(repr, expected))


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert packing.pack(docs).count() == 0
    assert bpe.encode_decode(docs).count() == 0

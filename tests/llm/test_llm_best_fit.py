import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shiftpay.llm import best_fit, encoder

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [
    "a", "b", "é", "ß", " ", "  ", "\n", "\t", "\r\n", "\x1c", "\x85", "\xa0", "'s", "'LL", "1", "²",
    "٣", "_", "-", "!!", "日本", "🙂", "\x00", "the", " The", "<|endoftext|>", " ing", "aaaa", "Ⅷ",
    "Σ", "ΑΣ ", "İ", "é", " ́", "don't", "<", "|>", "ſ", "Æ", "×", "ÿ", "x" * 70,
]


def texts(n: int) -> list[str]:
    draw = random.Random(4)
    return ["".join(draw.choices(PARTS, k=draw.randint(0, 25))) for _ in range(n)] + ["x" * 5000, ""]


@pytest.mark.parametrize("path", [WORDS, PIECES])
def test_ids_are_those_of_the_library(path, monkeypatch):
    some = texts(3000)
    library = Tokenizer.from_file(path)
    expected = [e.ids for e in library.encode_batch(some, add_special_tokens=False)]
    for memory in (encoder.MEMORY_BYTES, 1):  # the second forgets before each slice
        monkeypatch.setattr(encoder, "MEMORY_BYTES", memory)
        own = encoder.Encoder(path)
        assert own._kind and own._ranks is not None
        for low in range(0, len(some), 500):
            ids, places = own.ids(pa.array(some[low : low + 500]))
            found = [ids[a:b].tolist() for a, b in zip(places, places[1:])]
            assert found == expected[low : low + 500]


def test_other_rules_go_to_the_library(tmp_path):
    library = Tokenizer.from_file(PIECES)
    rules = library.to_str().replace('"add_prefix_space":false', '"add_prefix_space":true', 1)
    path = str(tmp_path / "other.json")
    with open(path, "w", encoding="utf-8") as file:
        file.write(rules)
    own, other = encoder.Encoder(path), Tokenizer.from_file(path)
    assert own._kind == ""
    some = texts(200)
    ids, places = own.ids(pa.array([*some, None]))
    expected = [e.ids for e in other.encode_batch([*some, ""], add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(places, places[1:])] == expected


def test_best_bin_and_fullest_closed():
    bins = best_fit.Bins(10, 2)
    assert bins.put(6) == (0, 0, [])
    assert bins.put(5) == (1, 0, [])
    assert bins.put(4) == (0, 6, [0])  # the least space that holds it
    assert bins.put(7) == (2, 0, [])
    assert bins.put(6) == (3, 0, [2])  # a third would be open: the fullest closes
    assert bins.put(5) == (1, 5, [1])


def test_bins_against_plain_search():
    draw = random.Random(1)
    bins, plain, order = best_fit.Bins(50, 6), {}, 0
    for _ in range(3000):
        length = draw.randint(1, 50)
        number, offset, closed = bins.put(length)
        fitting = [50 - used for used in plain.values() if used + length <= 50]
        if fitting:
            assert 50 - plain[number] == min(fitting)
        else:
            assert number == order
            order += 1
            if len(plain) == 6:
                assert plain[closed[0]] == max(plain.values())
        assert offset == plain.get(number, 0)
        plain[number] = offset + length
        for done in closed:
            assert plain.pop(done) == 50 or done != number
        assert len(plain) <= 6


ROWS = [(i, t, 7, "c") for i, t in enumerate(texts(80))] + [
    (None, "no id", 1, "c"), (5, None, 1, None), (5, "twice", 1, "c"), (5, "twice", 1, "c"),
]
SCHEMA = "doc_id long, text string, start int, ids string"


@pytest.mark.parametrize(("window", "bins"), [(16, 3), (2048, 512)])
def test_whole_documents_in_few_sequences(spark, window, bins):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(5)
    pieces = best_fit.best_fit(docs, window=window, open_bins=bins, with_ids=True).collect()
    sequences, documents = {}, {}
    for p in pieces:
        ids = bytes(p.ids)
        assert 0 < p.length == len(ids) // 4 <= window and p.ids_crc32 == zlib.crc32(ids)
        assert p.start == p.piece * window
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for some in sequences.values():
        at = 0
        for offset, length in sorted(some):
            assert offset == at
            at += length
        assert at <= window
    library = Tokenizer.from_file(WORDS)
    expected = []
    for i, text, *_ in ROWS:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        for k, start in enumerate(range(0, len(ids), window)):
            expected.append((i, k, ids[start : start + window]))
    found = [(p.doc_id, p.piece, np.frombuffer(p.ids, "<u4").tolist()) for p in pieces]
    assert sorted(map(repr, found)) == sorted(map(repr, expected))
    total = sum(p.length for p in pieces)
    assert len(sequences) <= 1.25 * -(-total // window) + 1


def test_full_on_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(4)
    pieces = best_fit.best_fit(docs)
    total, sequences = pieces.selectExpr("sum(length)", "count(distinct sequence_id)").first()
    assert sequences <= 1.02 * total / 2048 + 1


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert best_fit.best_fit(docs).count() == 0

import hashlib

import numpy as np
import pyarrow as pa
import pytest

from shiftpay.llm import fingerprints as fp, shared


def shingles(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def sketched(texts):
    return fp.sketch(*shared.raw_bytes(pa.array(texts, pa.string())))


def test_estimates_follow_similarity():
    draw = np.random.default_rng(5)
    words = np.array([f"w{i}" for i in range(5000)])
    errors = []
    for size in (3, 12, 60, 400, 3000):
        for share in (0.0, 0.5, 0.9, 1.0):
            a = draw.choice(words, size)
            b = a.copy()
            cut = int(size * share)
            b[cut:] = draw.choice(words, size - cut)
            a, b = " ".join(a), " ".join(b)
            values, some = sketched([a, b])
            got = fp.likeness(values[:1], values[1:], some[:1], some[1:])[0]
            errors.append(got - jaccard(a, b))
    assert abs(np.mean(errors)) < 0.03
    assert np.abs(errors).max() < 0.2


def test_few_words_and_none():
    values, some = sketched(["", " \n", "one", "one  ", "two words", "one two three four five"])
    assert some.tolist() == [False, False, True, True, True, True]
    assert (values[2] == values[3]).all() and (values[0] == values[1]).all()
    assert fp.likeness(values[:1], values[2:3], some[:1], some[2:3])[0] == 0
    assert fp.likeness(values[:1], values[1:2], some[:1], some[1:2])[0] == 1
    assert fp.likeness(values[2:3], values[4:5], some[2:3], some[4:5])[0] < 0.2


def test_a_text_has_the_same_sketch_in_any_company():
    texts = ["a b c d e f", "", "x", "ä ö ü ß é è " * 30]
    together, _ = sketched(texts)
    for k, text in enumerate(texts):
        assert (sketched([text])[0][0] == together[k]).all()


@pytest.mark.parametrize("slice_bytes", [2 << 20, 50])
def test_query_rows(spark, monkeypatch, slice_bytes):
    monkeypatch.setattr(shared, "SLICE_BYTES", slice_bytes)
    rows = [(i, f"{'ä' * i} b c d e f {i % 7} g h " * (i % 5)) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "long " * 3000), (103, rows[9][1])]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, fingerprint string")
    found = {r.doc_id: r for r in fp.fingerprints(docs.repartition(3)).collect()}
    order = sorted(rows, reverse=True, key=lambda r: r[0])
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        r = found[i]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        (a, b, c), some = sketched([text, edited, after])
        assert r.fingerprint == fp.packed(a[None])[0].hex()
        assert r.edited_fingerprint == fp.packed(b[None])[0].hex()
        assert r.near_edited == fp.likeness(a[None], b[None], some[:1], some[1:2])[0]
        assert r.near_next == fp.likeness(a[None], c[None], some[:1], some[2:])[0]
    assert found[103].fingerprint == found[9].fingerprint


def test_one_document_repeated_ids_and_none(spark):
    one = spark.createDataFrame([(1, "abc def")], "doc_id long, text string")
    (row,) = fp.fingerprints(one).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abc dab").hexdigest() and row.near_next == 1
    many = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, None)], one.schema)
    assert fp.fingerprints(many).count() == 5
    assert fp.fingerprints(one.limit(0)).count() == 0

import collections
import random

import numpy as np
import pytest

from shiftpay.llm import shared, suffixes


def brute(rows, length):
    """By every window of every text."""
    seen = collections.Counter()
    raw = [(i, (t or "").encode()) for i, t, *_ in rows]
    for _, b in raw:
        seen.update(b[k : k + length] for k in range(len(b) - length + 1))
    found = []
    for i, b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = True
        runs = int((gone[:-1] & ~np.r_[False, gone[:-1]][: len(b)]).sum()) if b else 0
        found.append((i, len(b), int(gone.sum()), runs, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(found, key=repr)


def rows():
    draw = random.Random(3)
    text = lambda letters, n: "".join(draw.choices(letters, k=n))
    made = [(i, text("ab", draw.randint(0, 300))) for i in range(20)]
    shared_ = text("abcdé ", 300)
    for i in range(30):
        cut = shared_[draw.randint(0, 60) : draw.randint(200, 300)]
        made.append((100 + i, text("xyz", draw.randint(0, 200)) + cut + text("xyz", draw.randint(0, 200))))
    return made + [
        (200, "a" * 500), (201, "a" * 230), (202, None), (203, ""), (200, "a" * 500), (None, shared_),
        (None, "b" * 90), (204, "abababab" * 60),
    ]


@pytest.mark.parametrize("length, limit", [(60, 20_000), (60, 3), (200, 20_000)])
def test_equals_brute_force(spark, monkeypatch, length, limit):
    monkeypatch.setattr(suffixes, "ANCHOR_LIMIT", limit)
    docs = spark.createDataFrame([(*r, 9) for r in rows()], "doc_id long, text string, n_spans int")
    found = suffixes.remove_repeats(docs.repartition(3), length).collect()
    found = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found), key=repr)
    assert found == brute(rows(), length)


def test_hot_anchors_count_windows_only_where_a_passage_ends(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "ANCHOR_LIMIT", 10)
    made, stage = {}, suffixes.stage

    def noted(frame, name, *more):
        made[name] = stage(frame, name, *more)
        return made[name]

    monkeypatch.setattr(suffixes, "stage", noted)
    draw = random.Random(5)
    text = lambda n: "".join(draw.choices("abcdefgh ", k=n))
    passage = text(260)
    some = [(k, text(300) + passage + text(300)) for k in range(60)]
    some += [(100 + k, f"{passage[:230]}{text(2)}{passage[232:]}") for k in range(20)]
    docs = spark.createDataFrame(some, "doc_id long, text string")
    found = suffixes.remove_repeats(docs).collect()
    found = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found), key=repr)
    assert found == brute(some, 200)
    around = made["surroundings"].join(made["hot-anchors"], "gram").agg({"windows": "sum"}).first()[0]
    assert 0 < made["counted-windows"].count() < around / 3


def test_real_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    plain = [tuple(r) for r in docs.collect()]
    found = sorted(
        ((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffixes.remove_repeats(docs).collect()),
        key=repr,
    )
    assert found == brute(plain, 200)


def test_as_text_drops_cut_characters(spark):
    passage = "é" * 150  # 300 bytes
    data = [(1, "x" + passage + "one"), (2, "yy" + passage + "two"), (3, None)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    found = {r.doc_id: r.text for r in suffixes.remove_repeats(docs, 200, as_text=True).collect()}
    assert found == {1: "xone", 2: "yytwo", 3: None}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffixes.remove_repeats(docs).count() == 0


def test_suffix_order_equals_sorting():
    draw = np.random.default_rng(1)
    data = draw.integers(97, 99, 600).astype(np.uint8)
    data[200:300] = data[50:150]
    sorter = suffixes.Suffixes(data, 40)
    at = draw.permutation(550)
    part = np.sort(draw.integers(0, 3, 550))
    found = sorter.sort(at, part)
    for k in range(3):
        expected = sorted(at[part == k], key=lambda p: data[p : p + 40].tobytes())
        got = [data[p : p + 40].tobytes() for p in found[part == k]]
        assert got == [data[p : p + 40].tobytes() for p in expected]
        assert sorted(found[part == k]) == sorted(at[part == k])


def test_windows_of_equal_content_have_anchors_alike():
    draw = np.random.default_rng(2)
    data = draw.integers(97, 101, 3000).astype(np.uint8)
    data[2000:2500] = data[100:600]
    text, place, first, last, _ = suffixes.window_anchors(data, np.array([0, 1500, 3000]), 200)
    assert sum(last - first + 1) == 2 * (1500 - 200 + 1)
    at = {}
    for p, a, b in zip(place, first, last):
        for start in range(a, b + 1):
            assert start <= p <= start + 200 - suffixes.ANCHOR
            assert at.setdefault(data[start : start + 200].tobytes(), p - start) == p - start


def test_long_texts_find_the_same_places(monkeypatch):
    hashes = shared.mixed(np.arange(5000, dtype=np.uint64) % np.uint64(700))
    whole = suffixes._least_places(hashes, 50)
    monkeypatch.setattr(suffixes, "_PLACE_BITS", 9)
    parts = suffixes._least_places(hashes, 50)
    mask = ~np.uint64((1 << 22) - 1)
    for w, (a, b) in enumerate(zip(whole, parts)):
        run = hashes[w : w + 50]
        assert a == w + np.argmin(run & mask)
        assert b == w + np.argmin(run & ~np.uint64((1 << 9) - 1))

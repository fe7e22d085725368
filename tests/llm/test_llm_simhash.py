import random

import numpy as np
import pytest
import xxhash

from shiftpay.llm import simhash
from shiftpay.llm.components import components


def smallest(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def near_values(n, seed=0):
    draw = np.random.default_rng(seed)
    base = draw.integers(0, 2**63, n // 4, dtype=np.uint64)
    parts = [base]
    for _ in range(3):
        flips = [np.uint64(k) << draw.integers(0, 60, len(base)).astype(np.uint64) for k in (1, 1, 7)]
        parts.append(base ^ flips[0] ^ flips[1] ^ flips[2])
    return np.unique(np.concatenate(parts))


@pytest.mark.parametrize("n", [0, 4, 60, 900])
def test_trie_equals_all_pairs(n):
    values = near_values(n)
    x, y = simhash.trie_links(values, np.zeros(len(values), int), 4)
    near = np.argwhere(np.bitwise_count(values[:, None] ^ values[None, :]) <= 4)
    assert smallest(len(values), zip(x, y)) == smallest(len(values), near)


def test_trees_stay_apart():
    values = np.array([1, 3, 1, 3], np.uint64)
    x, y = simhash.trie_links(values, np.array([0, 0, 1, 1]), 4)
    assert sorted(zip(x.tolist(), y.tolist())) == [(1, 0), (3, 2)]


@pytest.mark.parametrize("limit", [50_000, 3])
def test_links_in_spark_equal_all_pairs(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash, "TRIE_LIMIT", limit)
    values = near_values(400, 1)
    rows = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "value long")
    place = {int(v): i for i, v in enumerate(values.view(np.int64))}
    links = [(place[r.a], place[r.b]) for r in simhash.near_links(rows.repartition(3)).collect()]
    near = np.argwhere(np.bitwise_count(values[:, None] ^ values[None, :]) <= 4)
    assert smallest(len(values), links) == smallest(len(values), near)
    assert all(np.bitwise_count(values[a] ^ values[b]) >= 0 for a, b in links)


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def documents():
    draw = random.Random(7)
    words = ["".join(draw.choices("abcdefgh", k=5)) for _ in range(300)]
    rows = []
    for i in range(60):
        text = draw.choices(words, k=draw.randint(1, 200))
        rows.append((1000 + i, " ".join(text)))
        if i % 3 == 0:
            rows.append((i, " ".join(text).upper()))
        if i % 4 == 0 and len(text) > 100:
            text[50] = "Changed"
            rows.append((500 + i, "\t".join(text)))
    return rows + [
        (2000, None), (2001, ""), (2002, " \n"), (3, "one two"), (3, "one two"), (None, "one  TWO"),
        (4, "ÀÉ one two three four"), (None, "alone with a null id"),
    ]


def test_groups_equal_brute_force(spark):
    rows = documents()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, a string, value int")
    found = simhash.groups(docs.repartition(3)).collect()
    values = np.array([plain_fingerprint(t) for _, t in rows], np.uint64)
    near = np.argwhere(np.bitwise_count(values[:, None] ^ values[None, :]) <= 4)
    roots = smallest(len(rows), near)
    least = {}
    for root, (i, _) in zip(roots, rows):
        if i is not None:
            least[root] = min(i, least.get(root, i))
    expected = [(i, int(v), least.get(r)) for (i, _), v, r in zip(rows, values.view(np.int64), roots)]
    assert sorted(map(repr, expected)) == sorted(repr(tuple(r)) for r in found)
    kept = simhash.keep_one(docs.repartition(2))
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == sorted(least.values())  # one row for each group, also where two share an id
    assert kept.where("doc_id is null").count() == len(set(roots)) - len(least)


def test_one_stays_of_each_group_whatever_its_ids(spark):
    texts = {k: " ".join(f"{k}{i}" for i in range(40)) for k in "abcd"}
    rows = [(None, texts["a"]), (None, texts["a"].upper()), (None, texts["b"]), (None, texts["b"])]
    rows += [(7, texts["c"]), (8, texts["c"].upper()), (7, texts["d"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((str(r.doc_id), r.text[0].lower()) for r in simhash.keep_one(docs.repartition(3)).collect())
    assert kept == [("7", "c"), ("7", "d"), ("None", "a"), ("None", "b")]


def test_fingerprint_of_long_text():
    text = " ".join(str(i % 977) for i in range(70_000))
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(50)] + [(7, 7), (None, 3)]
    rows = spark.createDataFrame(links, "a long, b long")
    found = {r.node: r.root for r in components(rows).collect()}
    assert found == {i: 0 for i in range(41)} | {100: 100} | {200 + i: 100 for i in range(50)}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.groups(docs).count() == 0
    assert simhash.keep_one(docs).count() == 0

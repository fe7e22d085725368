import math

import duckdb
import numpy as np
import pytest

from shiftpay.llm import negatives, queries

NAN, INF = float("nan"), float("inf")


def expected(rows):
    some = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [max(-(1 << 24), min(1 << 24, math.floor(256 * x))) for x in v]
        some.append((i, whole, (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for a, (anchor, u, own) in enumerate(some):
        if anchor % 100:
            continue
        scored = [
            (-sum(x * y for x, y in zip(u, v)), i, label)
            for c, (i, v, label) in enumerate(some)
            if c != a and len(v) == len(u)
        ]
        near = sorted(s for s in scored if s[2] == own)[:5]
        far = sorted(s for s in scored if s[2] != own)
        for p, positive, _ in near:
            fits = [s for s in far if 30 * -p <= 100 * -s[0] <= 90 * -p][:10]
            for rank, (n, negative, _) in enumerate(fits, 1):
                out.append((anchor, positive, rank, negative, -p, -n))
    return sorted(out)


def table(kind):
    draw = np.random.default_rng(9)
    x = draw.normal(size=(900, 12))
    if kind == "one cone":
        x = x * 0.3 + draw.normal(size=12) * 2
    elif kind == "large":
        x *= 3e4
    elif kind == "ties":
        x = np.round(x)
    rows = [(int(i), v.tolist(), int(i * 7919 % 5)) for i, v in enumerate(x)]
    if kind == "one label":  # a label that holds a third of the rows, and others
        rows = [(i, v, 0 if i % 3 == 0 else k) for i, v, k in rows]
    return rows + [
        (1000, None, 1), (1100, [1.0] * 12, None), (None, [1.0] * 12, 1), (1200, [1.0, None] * 6, 1),
        (1300, [NAN] * 12, 1), (1400, [INF] * 12, 2), (1500, [0.0] * 12, 1), (1600, [], 1),
        (1700, [1.0, 2.0], 1), (1701, [2.0, 1.0], 1), (1702, [1.0, 1.0], 3), (100, x[100].tolist(), 0),
        (7, x[8].tolist(), 3), (7, x[8].tolist(), 3),
    ]


@pytest.mark.parametrize("kind", ["plain", "one cone", "large", "ties", "one label"])
def test_equals_all_pairs(spark, monkeypatch, kind):
    monkeypatch.setattr(negatives, "CLUSTER", 3)
    monkeypatch.setattr(negatives, "LIST", 200)
    monkeypatch.setattr(negatives, "STEP", 16)
    monkeypatch.setattr(negatives, "BLOCK_NUMBERS", 500)  # several blocks of anchors
    rows = table(kind)
    vectors = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, anchor string, slot int")
    found = sorted(tuple(r) for r in negatives.hard_negatives(vectors.repartition(4)).collect())
    assert found == expected(rows)
    assert len(found) > 50


def test_walks_end_early(monkeypatch):
    """Bounds leave out most candidates of other directions."""
    draw = np.random.default_rng(1)
    centers = draw.normal(size=(40, 32)) * 300
    values = np.floor(np.repeat(centers, 100, axis=0) + draw.normal(size=(4000, 32)) * 10)
    some = np.arange(0, 4000, 100)
    ones = np.ones((len(some), 1), np.int64)
    anchors = negatives.Anchors(
        some, np.zeros(len(some), np.int64), values[some], True, 5,
        ones * negatives._NONE, ones * negatives._NEVER, ones * negatives._NONE,
    )
    seen = []
    products = negatives._products
    monkeypatch.setattr(negatives, "CLUSTER", 1)
    monkeypatch.setattr(negatives, "_products", lambda a, b: seen.append(len(a) * len(b)) or products(a, b))
    anchors.__post_init__()
    walk = negatives.Walk(anchors)
    walk.add(np.arange(4000), np.arange(4000), np.zeros(4000, np.int64), values)
    assert sum(seen) < 0.3 * len(some) * 4000
    row, _, score, vec_id = walk.found()
    for r in some:
        scores = values @ values[r]
        best = sorted((-s, i) for i, s in enumerate(scores) if i != r)[:5]
        assert sorted(zip(-score[row == r], vec_id[row == r])) == best


def test_equals_sql(spark):
    base = "/root/testdata/sf0.01"
    found = queries.op13_hard_negatives(spark, base)
    with duckdb.connect() as db:
        db.sql(f"CREATE VIEW embeddings AS FROM '{base}/embeddings.parquet'")
        rows = db.sql(queries.oracle_sql()["op13_hard_negatives"])
        assert rows.columns == found.columns
        assert sorted(rows.fetchall()) == sorted(tuple(r) for r in found.collect())


def test_empty_table(spark):
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert negatives.hard_negatives(vectors).count() == 0

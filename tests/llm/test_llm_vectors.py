import numpy as np
import pytest

from shiftpay.llm import pivots


def expected(rows):
    usable = []
    for i, v in rows:
        x = np.array([np.nan if e is None else e for e in (v or [])], np.float64)
        fine = len(x) and np.isfinite(x).all() and x.any()
        x = x / np.abs(x).max() if fine else x
        usable.append(x / np.linalg.norm(x) if fine else None)
    n = len(rows)
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * n
    for a in range(n):
        for b in range(a):
            if usable[a] is not None and usable[b] is not None and len(usable[a]) == len(usable[b]):
                if usable[a] @ usable[b] >= 0.9:
                    links[a] += 1
                    links[b] += 1
                    root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(i, least.get(find(k), i))
    return sorted((i, links[k], least[find(k)], i == least[find(k)]) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("limit", [4096, 5])
def test_equals_all_pairs(spark, monkeypatch, limit):
    monkeypatch.setattr(pivots, "LIST_LIMIT", limit)
    draw = np.random.default_rng(3)
    base = draw.normal(size=(60, 16))
    rows = [(int(1000 - k), base[k].tolist()) for k in range(60)]
    for k in range(60):
        near = base[k % 12] + draw.normal(size=16) * 0.05
        rows.append((k, near.tolist()))
    rows += [(2000 + k, base[0].tolist()) for k in range(5)] + [(2100, (base[1] * 1e200).tolist())]
    rows += [
        (3000, None), (3001, []), (3002, [0.0] * 16), (3003, [1.0, None] * 8), (3004, [float("nan")] * 16),
        (3005, [float("inf")] * 16), (3006, [1.0, 2.0]), (3007, [2.0, 4.0]), (3008, [0.0, -0.0]),
        (3009, [1.0, 0.0]), (3010, [1.0, -0.0]),
    ]
    vectors = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, class int")
    found = sorted(tuple(r) for r in pivots.near_vectors(vectors.repartition(3)).collect())
    assert found == expected(rows)


def test_recall_on_given_embeddings(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = vectors.orderBy("vec_id").toPandas()
    x = np.array(rows["embedding"].tolist(), np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = (x @ x.T >= 0.9).sum(axis=1) - 1
    found = pivots.near_vectors(vectors).orderBy("vec_id").toPandas()
    assert (found["n_links"] <= links).all()
    assert found["n_links"].sum() >= 0.9 * links.sum()


def test_recall_near_the_threshold(spark):
    """Pairs at a cosine of just over 0.9, the hardest ones."""
    draw = np.random.default_rng(8)
    base = draw.normal(size=(1000, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    other = draw.normal(size=(1000, 64))
    other -= (other * base).sum(axis=1, keepdims=True) * base
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    near = 0.905 * base + np.sqrt(1 - 0.905**2) * other
    rows = [(k, v.tolist()) for k, v in enumerate(np.concatenate([base, near]))]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = pivots.near_vectors(vectors).agg({"n_links": "sum"}).first()[0]
    assert 0.9 * 2000 <= found <= 2000


@pytest.mark.parametrize("share", [3, 1])
@pytest.mark.parametrize("cosine", [0.91, 0.95])
def test_recall_in_a_cluster(spark, share, cosine):
    """A third of the vectors, or all, are near each other and not equal."""
    draw = np.random.default_rng(5)
    x = draw.normal(size=(1800, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    center = draw.normal(size=64) / 8
    x[: 1800 // share] = np.sqrt(cosine) * center + np.sqrt(1 - cosine) * x[: 1800 // share]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = (x @ x.T >= 0.9).sum() - len(x)
    vectors = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = pivots.near_vectors(vectors).agg({"n_links": "sum"}).first()[0]
    assert 0.9 * links <= found <= links


def test_empty_table(spark):
    assert pivots.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0

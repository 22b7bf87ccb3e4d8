"""Vector links against all pairs."""

import numpy as np
import pytest

from leafray.llm import hnsw


def data(seed, n=260):
    r = np.random.default_rng(seed)
    out = []
    base = r.normal(size=(40, 24))
    for i in range(n):
        v = base[r.integers(40 if i % 3 else 2)] + r.normal(size=24) * r.choice([0.0, 0.05, 0.15, 0.3])
        out.append((int(i * 7 % 1009), v.astype(np.float32).tolist(), int(r.integers(2))))
    v = out[0][1]
    odd = [None, [], [0.0] * 24, [None, *v[1:]], [float("nan"), *v[1:]], [float("inf"), *v[1:]], v[:5], [2 * x for x in v], v]
    out += [(2000 + k, x, out[0][2]) for k, x in enumerate(odd)]
    return out + [(3000, v, None), (3001, v, 99), (2008, v, out[0][2]), (None, v, out[0][2])]


def brute(rows, threshold):
    good = [i for i, (_, v, l) in enumerate(rows) if l is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    n = [0] * len(rows)
    for k, i in enumerate(good):
        for j in good[:k]:
            a, b = rows[i], rows[j]
            if a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1]), np.array(b[1])
                if a[1] == b[1] or x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= threshold:
                    n[i] += 1
                    n[j] += 1
                    up[root(i)] = root(j)
    low = {}
    for i, (d, *_) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(low.get(root(i), d), d)
    return sorted(((d, n[i], low.get(root(i)), d == low.get(root(i))) for i, (d, *_) in enumerate(rows)), key=str)


@pytest.mark.parametrize("shard", [10_000, 40])
def test_against_all_pairs(spark, monkeypatch, shard):
    monkeypatch.setattr(hnsw, "SHARD", shard)
    monkeypatch.setattr(hnsw, "LEAST_QUERIES", 25)
    rows = data(shard)
    table = spark.createDataFrame([(l, v, d, 5) for d, v, l in rows], "label int, embedding array<float>, vec_id long, node int")
    got = hnsw.near_vectors(spark, table).collect()
    assert sorted(((x.vec_id, x.n_links, x.component_id, x.kept) for x in got), key=str) == brute(rows, hnsw.THRESHOLD)


def test_recall_of_larger_graph():
    r = np.random.default_rng(1)
    base = r.normal(size=(150, 64))
    x = np.concatenate([base + r.normal(size=base.shape) * s for s in (0, 0.05, 0.1, 0.12, 0.14, 0.2)] + [base[:1] + r.normal(size=(400, 64)) * 0.09])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    graph = hnsw.Graph.load(u, hnsw.Graph(u).dump())
    found, (met, wanted) = hnsw.search_group(graph, u, u, 0.98)
    recall = met / wanted
    truth = u @ u.T >= 0.98
    met = sum(len(set(f.tolist()) & set(np.flatnonzero(t).tolist())) for f, t in zip(found, truth, strict=True))
    assert recall >= hnsw.AUDIT_RECALL and met / truth.sum() > 0.99
    assert all(truth[i][f].all() for i, f in enumerate(found))


def test_empty(spark):
    assert hnsw.near_vectors(spark, spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_links_count_at_both_ends(spark):
    r = np.random.default_rng(5)
    x = np.repeat(r.normal(size=(30, 16)), 6, axis=0) + r.normal(size=(180, 16)) * 0.04
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    table = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = hnsw.near_vectors(spark, table).orderBy("vec_id").collect()
    assert [g.n_links for g in got] == [int(t.sum()) - 1 for t in x @ x.T >= 0.98]


def test_prints_are_the_same_from_both_ends():
    ids = np.arange(50) * 7919
    table = np.stack([hnsw._prints(int(a), ids) for a in ids])
    assert (table == table.T).all() and len(np.unique(table)) == 50 * 51 // 2


def test_extreme_sizes(spark):
    v = [0.3, -0.2, 0.5]
    rows = [(1, v), (2, [x * 1e200 for x in v]), (3, [x * 1e-200 for x in v]), (4, [5e-324, 0.0, 0.0]), (5, [1.7e308, 0.0, 0.0])]
    table = spark.createDataFrame([(i, x, 1) for i, x in rows], "vec_id long, embedding array<double>, label int")
    got = {x.vec_id: (x.n_links, x.component_id, x.recall) for x in hnsw.near_vectors(spark, table).collect()}
    assert got == {1: (2, 1, 1.0), 2: (2, 1, 1.0), 3: (2, 1, 1.0), 4: (1, 4, 1.0), 5: (1, 4, 1.0)}

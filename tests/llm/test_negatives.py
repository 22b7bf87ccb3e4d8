"""Hard negatives against plain scoring of all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafray.llm import negatives

SCHEMA = "vec_id long, label string, vector array<double>, node int, copies string, asks int"


def brute(data, asks, k=5, n=3, least=50, most=95):
    rows = [(i, d, lab, [int(x) for x in v]) for i, (d, lab, v) in enumerate(data) if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    clip = lambda s: min(max(s, -(2**63)), 2**63 - 1)
    key = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for i, d, lab, v in rows:
        if d is None or not asks(d):
            continue
        all_ = [(clip(sum(a * b for a, b in zip(v, w))), e, m == lab) for j, e, m, w in rows if j != i and len(w) == len(v)]
        for p, e, _ in sorted([x for x in all_ if x[2]], key=key)[:k]:
            fit = sorted([x for x in all_ if not x[2] and least * p <= 100 * x[0] <= most * p], key=key)[:n]
            out += [(d, e, r, f, p, s) for r, (s, f, _) in enumerate(fit, 1)]
    return sorted(out, key=str)


def run(spark, data, asks="vec_id % 3 = 0", **more):
    table = spark.createDataFrame([(*x, 1, "c", 0) for x in data], SCHEMA)
    return sorted((tuple(x) for x in negatives.hard_negatives(spark, table, F.expr(asks), **more).collect()), key=str)


def corpus(seed, n, dims, size):
    r = random.Random(seed)
    centre = {lab: [r.randint(-size, size) for _ in range(dims)] for lab in "abc"}
    data = []
    for i in range(n):
        lab = "a" if r.random() < 0.4 else r.choice("abc")
        other = centre[r.choice("abc")]
        data.append((i, lab, [float((3 * x + y) // 4 + r.randint(-size // 4, size // 4)) for x, y in zip(centre[lab], other)]))
    return data


def odd(data, dims):
    v = data[0][2]
    more = [(None, "a", v), (None, "b", v), (3, "a", v), (3, "a", v), (3, "a", v), (3, "b", v), (9, None, v), (9, "a", None), (9, "a", [float("nan")] * dims), (9, "a", [float("inf")] + v[1:])]
    more += [(12, "a", [None] + v[1:]), (15, "a", []), (16, "b", []), (18, "a", [0.0] * dims), (21, "b", [0.0] * dims), (24, "c", [2.0, 3.0]), (25, "c", [2.0, 3.0]), (26, "a", [2.0, 2.0])]
    return data + more + [(100 + i, "b", v) for i in range(30)]


@pytest.mark.parametrize(("seed", "dims", "size"), [(1, 6, 150), (2, 3, 4000), (3, 5, 2**33)])
def test_against_all_pairs(spark, monkeypatch, seed, dims, size):
    monkeypatch.setattr(negatives, "CANDIDATES", 40)
    monkeypatch.setattr(negatives, "ANCHORS", 16)
    monkeypatch.setattr(negatives, "TOGETHER", 2)
    monkeypatch.setattr(negatives, "SLICE", 7)
    data = odd(corpus(seed, 150, dims, size), dims)
    assert run(spark, data) == brute(data, lambda d: d % 3 == 0)


def test_few_rows_and_none(spark):
    assert run(spark, []) == []
    assert run(spark, [(3, "a", [1.0, 2.0])]) == []
    data = [(3, "a", [10.0, 2.0]), (4, "a", [9.0, 3.0]), (5, "b", [6.0, 3.0])]
    assert run(spark, data) == brute(data, lambda d: d % 3 == 0) == [(3, 4, 1, 5, 96, 66)]
    huge = [(3, "a", [1e30, 2.0]), (4, "a", [9e29, 3.0]), (5, "b", [6.0, 3.0]), (6, "a", [3.0, 3.0]), (7, "b", [3.0, 2.0])]
    assert run(spark, huge) == brute(huge, lambda d: d % 3 == 0)


@pytest.mark.parametrize("size", [3, 200, 3000, 2**29, 2**40])
def test_packed_products_are_exact(size):
    r = np.random.default_rng(size)
    a, c = r.integers(-size, size + 1, (5, 64)), r.integers(-size, size + 1, (37, 64))
    want = a.astype(object) @ c.astype(object).T
    if size >= 2**29:
        want = np.clip(want, -(2**63), 2**63 - 1)
    assert (negatives.scores(a, c) == want).all()
    c[3] *= 1000
    want = np.clip(a.astype(object) @ c.astype(object).T, -(2**63), 2**63 - 1)
    assert (negatives.scores(a, c) == want).all()


def test_two_unit_vectors_share_a_number():
    """Components in units of 1/256 of vectors of length one leave room for two candidates and more in a double."""
    a = np.full((1, 64), 160) - np.array([[-160]])
    assert negatives.DOUBLE_BITS // negatives.field_bits(a, a) == 2


def test_hot_label(spark):
    """Most rows of one label, many of them equal: nothing is lost."""
    r = random.Random(5)
    data = [(i, "a", [100.0, float(r.randint(0, 3))]) for i in range(900)] + [(900 + i, "b", [70.0, float(i % 7)]) for i in range(100)]
    assert run(spark, data, "vec_id % 50 = 0") == brute(data, lambda d: d % 50 == 0)

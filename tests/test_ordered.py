"""Neighbours in time and exact quantiles against plain Python, and the growth of their work."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafray.operators import joins, ordered


@pytest.mark.parametrize("width", [3.0, 50.0, 1e9])
def test_around(spark, width):
    r = random.Random(int(width))
    knots = sorted({(r.choice(["a", "b", None]), float(r.randint(0, 400))) for _ in range(60)}, key=str)
    targets = [(r.choice(["a", "b", "c", None]), float(r.randint(-50, 450)), i) for i in range(300)]
    k = spark.createDataFrame(knots, "k string, t double").withColumn("own", F.struct("t"))
    got = ordered.around(k, spark.createDataFrame(targets, "k string, t double, i int"), ["k"], "t", "own", width).collect()
    assert len(got) == len(targets)
    for x in got:
        own = [t for kk, t in knots if kk == x.k]
        before, after = max((t for t in own if t <= x.t), default=None), min((t for t in own if t >= x.t), default=None)
        assert (x.before_ and x.before_.t, x.after_ and x.after_.t) == (before, after)


def test_exact_quantiles(spark):
    r = np.random.default_rng(1)
    groups = {"big": np.round(r.lognormal(0, 2, 250_000), 3), "ties": r.integers(0, 3, 120_000).astype(float), "few": r.random(7), "one": np.array([4.0])}
    df = spark.createDataFrame([(g, float(v)) for g, x in groups.items() for v in x] + [("big", None)], "g string, v double")
    ps = [0.0, 0.05, 0.25, 0.5, 0.99, 1.0]
    for x in ordered.exact_quantiles(df, F.col("v"), ps, by=["g"]).collect():
        assert np.allclose(x.q, np.quantile(groups[x.g], ps), rtol=1e-12)
    assert np.allclose(ordered.exact_quantiles(df, F.col("v"), ps).first().q, np.quantile(np.concatenate(list(groups.values())), ps), rtol=1e-12)
    assert ordered.exact_quantiles(df.where("g is null"), F.col("v"), ps).first().q == []


def test_nearest_asof_is_linear(spark):
    """One key with eight times the rows takes no more than about eight times as long."""

    def took(n):
        side = lambda seed: spark.range(n).select(F.lit(1).alias("k"), F.timestamp_millis((F.rand(seed) * 8.64e7).cast("long")).cast("timestamp_ntz").alias("ts"), F.col("id").alias("v"))
        start = time.perf_counter()
        out = joins.nearest_asof(side(1).drop("v"), side(2), ["k"], "ts", ["v"], part_seconds=3600)
        assert out.where("v is not null").count() == n
        return time.perf_counter() - start

    took(1000)
    small, large = took(10_000), took(80_000)
    assert large < 10 * max(small, 1.0)


def test_sliding_median_deviation():
    from leafray.operators import robust

    r = random.Random(4)
    for _ in range(300):
        n = r.randint(1, 40)
        times = sorted(r.randint(0, 60) for _ in range(n))
        values = [r.choice([None, 0.0, 1.0, r.random(), r.random() * 30]) for _ in range(n)]
        reach, want = r.randint(0, 20), []
        for t, v in zip(times, values, strict=True):
            frame = np.array([x for s, x in zip(times, values, strict=True) if x is not None and abs(s - t) <= reach])
            mad = np.median(np.abs(frame - np.median(frame))) if len(frame) else 0
            want.append(bool(v is not None and len(frame) >= 5 and mad > 0 and abs(v - np.median(frame)) > 2 * robust.SCALE * mad))
        assert robust._sliding(times, values, reach, 2.0, 5) == want

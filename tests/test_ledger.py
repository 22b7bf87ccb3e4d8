"""Ledger verdicts against all pairs, and how many rows they form."""

import datetime as dt
import random

import pytest

from leafray.operators import joins
from leafray.plans import registry

SCHEMA = "file_hash string, start timestamp_ntz, end timestamp_ntz"
T0 = dt.datetime(2024, 1, 1)


def intervals(r, n, hashes):
    out = []
    for _ in range(n):
        a = r.randint(0, 3000)
        out.append((r.choice([None, *hashes]), T0 + dt.timedelta(seconds=a), r.choice([None] + 9 * [T0 + dt.timedelta(seconds=a + r.randint(-2, r.choice([5, 80, 900])))])))
    return out


def brute(batch, ledger):
    last, out = dt.datetime.max, []
    for h, a, b in batch:
        reason, end = None, b or last
        if h is not None and any(h == x for x, _, _ in ledger):
            reason = "hash_match"
        elif h is not None and a <= end and any(c <= (d or last) and c <= end and (d or last) >= a for _, c, d in ledger):
            reason = "temporal_overlap"
        elif h is not None and b and a <= b and any(x and x != h and d and c <= a and d >= b for x, c, d in batch):
            reason = "contained"
        out.append((h, a, b, reason))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(4))
def test_against_all_pairs(spark, seed):
    r = random.Random(seed)
    batch = intervals(r, 60, [f"h{i}" for i in range(r.choice([6, 60]))])
    ledger = [x for x in intervals(r, 4, ["h1", "z"]) if x[2]]
    got = joins.ledger_verdicts(spark.createDataFrame(batch, SCHEMA), spark.createDataFrame(ledger, SCHEMA), 300)
    assert sorted(map(tuple, got.collect()), key=str) == brute(batch, ledger)


def test_query_gives_every_order_a_verdict(spark):
    sf = "/root/testdata/sf0.001"
    assert registry.QUERIES["dedup_hash_or_overlap_all"](spark, sf).count() == registry._intervals(spark, sf).count()

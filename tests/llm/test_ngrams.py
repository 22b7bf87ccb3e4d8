"""Backoff scores of any vocabulary against counting in plain Python."""

import math
import random
from collections import Counter

import pytest

from leafray.llm import ngrams, queries
from leafray.llm.toxicity import tokens


def brute(data, order, leave_out):
    split = [tokens(t) for _, t in data]
    grams = lambda t: Counter(tuple(t[i : i + k]) for k in range(1, order + 1) for i in range(len(t) - k + 1))
    corpus, out = Counter(), []
    for t in split:
        corpus.update(grams(t))
    for (d, _), t in zip(data, split, strict=True):
        own = grams(t) if leave_out else Counter()
        total = sum(map(len, split)) - (len(t) if leave_out else 0)
        count = lambda g: corpus[g] - own[g]  # noqa: E731, B023
        s = 0.0
        for i in range(len(t)):
            one = math.log(max(count((t[i],)), 1) / max(total, 1))
            for k in range(2, min(order, i + 1) + 1):
                g = tuple(t[i - k + 1 : i + 1])
                one = math.log(count(g) / count(g[:-1])) if count(g) else math.log(ngrams.BACKOFF) + one
            s += one
        out.append((d, len(t), s, s / len(t) if t else None))
    return out


def agree(got, want):
    key = lambda x: (str(x[0]), x[1], round(x[2], 3))
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-4 and (a[3] is b[3] or abs(a[3] - b[3]) < 1e-5)


def sample(seed):
    r = random.Random(seed)
    data = [(i, " ".join(r.choice(["the", "The", "of.", "a", "é", "w%d" % r.randint(0, 200)]) for _ in range(r.randint(0, 60)))) for i in range(120)]
    return data + [(500, None), (501, ""), (502, "!!! --"), (503, "loop " * 20000), (7, data[7][1]), (7, data[7][1]), (None, "the of"), (504, "alone")]


@pytest.mark.parametrize(("order", "leave_out", "piece", "buckets"), [(2, True, 1 << 22, 3), (2, False, 50, 256), (3, False, 50, 3), (3, True, 200, 7), (4, True, 2000, 3), (1, True, 50, 3)])
def test_against_plain_counts(spark, monkeypatch, order, leave_out, piece, buckets):
    monkeypatch.setattr(ngrams, "BATCH", 50 if piece < 1 << 22 else 1 << 20)
    monkeypatch.setattr(ngrams, "LEAST_BUCKETS", buckets)
    data = sample(order + piece)
    table = spark.createDataFrame([(d, t, 1, 2.0) for d, t in data], "doc_id long, text string, batch int, counts double")
    agree(ngrams.scores(spark, table, order, leave_out).collect(), brute(data, order, leave_out))


@pytest.mark.parametrize(("name", "leave_out"), [("op3_backoff", True), ("op3_backoff_trigrams", False)])
def test_queries_leave_nothing_out(spark, tmp_path, name, leave_out):
    data = sample(2)
    spark.createDataFrame(data, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    agree(queries.QUERIES[name](spark, str(tmp_path)).collect(), brute(data, 3, leave_out))


@pytest.mark.parametrize("leave_out", [True, False])
def test_odd_tables(spark, leave_out):
    for data in ([], [(1, None)], [(1, ""), (2, "!")], [(1, "one text alone here")], [(None, "a b c")] * 3):
        table = spark.createDataFrame(data, "doc_id long, text string")
        agree(ngrams.scores(spark, table, 3, leave_out).collect(), brute(data, 3, leave_out))

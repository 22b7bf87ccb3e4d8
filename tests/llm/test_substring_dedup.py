"""Passage removal against direct comparison of all windows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from leafray.llm import substring_dedup


def brute(data, window):
    split = [(t or "").encode().split() for _, t in data]
    order = [substring_dedup.LAST if d is None else d for d, _ in data]
    first = {}
    for d, w in zip(order, split, strict=True):
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            first[k] = min(first.get(k, d), d)
    out = []
    for (d, _), o, w in zip(data, order, split, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < o:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, data, window):
    table = spark.createDataFrame([(d, t, 0, "x") for d, t in data], "doc_id long, text string, row int, anchors string")
    found = substring_dedup.remove_repeats(spark, table, window)
    sha = F.coalesce(F.sha2("kept_text", 256), F.lower(F.hex("joined_sha")))
    return sorted((tuple(x) for x in found.select("doc_id", "n_words", "n_removed", sha).collect()), key=str)


def corpus(seed, window):
    r = random.Random(seed)
    word = lambda: r.choice(["a", "b", "c", "é", "dd"]) + str(r.randint(0, 30))
    passages = [[word() for _ in range(r.randint(window - 3, 3 * window))] for _ in range(8)]
    data = []
    for d in r.sample(range(1000), 70):
        text = []
        for _ in range(r.randint(0, 4)):
            p = r.choice(passages)
            cut = r.randint(0, 4)
            text += [word() for _ in range(r.randint(0, 12))] + p[cut : len(p) - r.randint(0, 4)]
        data.append((d, r.choice([" ", "\n", "  "]).join(text)))
    data += [(2000, data[0][1]), (2000, data[1][1]), (2000, data[1][1]), (None, data[2][1]), (1500, None), (1501, ""), (1502, " ".join(["w"] * 5000)), (1503, " ".join(["w"] * 70))]
    return data


@pytest.mark.parametrize(("seed", "window", "wide"), [(1, 20, 8), (2, 50, 8), (3, 20, 0), (4, 50, 1)])
def test_against_all_windows(spark, monkeypatch, seed, window, wide):
    monkeypatch.setattr(substring_dedup, "WIDE", wide)
    monkeypatch.setattr(substring_dedup, "SHARD", 150)
    monkeypatch.setattr(substring_dedup, "GROUP", 2000)
    data = corpus(seed, window)
    assert run(spark, data, window) == brute(data, window)


def test_nothing_to_do(spark):
    assert run(spark, [], 50) == []
    assert run(spark, [(1, "a b"), (2, "a b")], 50) == brute([(1, "a b"), (2, "a b")], 50)


def test_many_null_and_repeated_ids(spark):
    r = random.Random(7)
    text = lambda: " ".join(r.choice("abcdefgh") + str(r.randint(0, 99)) for _ in range(60))
    common = text()
    data = [(5, common)] + [(None, f"{text()} {common}") for _ in range(3000)] + [(9, f"{common} {text()}") for _ in range(3000)] + [(None, common)] * 50
    assert run(spark, data, 50) == brute(data, 50)

"""Mixing against a plain recursive dealing and a sorted stream."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from leafray.llm import mixing

WEIGHTS = {"domain": {"a": 3}, "lang": {"en": 5, "de": 2}}


def words(t):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]


def deal(budget, children):
    """children: (name, weight, supply); shares by repeated dealing of what full children leave."""
    open_, share = sorted(children, key=lambda c: (c[2] / c[1], c[0] is not None, c[0] or "")), {}
    left = budget
    while open_:
        w = sum(c[1] for c in open_)
        name, weight, supply = open_[0]
        if supply * w <= left * weight:
            share[name] = supply
            left -= supply
            open_.pop(0)
        else:
            share |= {c[0]: left * c[1] // w for c in open_}
            break
    return share


def brute(data, budget, epochs, seed):
    leaves = {}
    for d, text, lang, source in data:
        if n := len(words(text)):
            leaves.setdefault((source[0] if source else None, lang, source), []).append((d, n))
    supply = {k: sum(n for _, n in v) * epochs for k, v in leaves.items()}
    total = sum(supply.values()) // epochs
    up = lambda i, k: sum(s for x, s in supply.items() if x[:i] == k)
    out = []
    top = deal(int(total * budget), [(d, WEIGHTS["domain"].get(d, 1), up(1, (d,))) for d in {k[0] for k in leaves}])
    for d, b in top.items():
        mid = deal(b, [(l, WEIGHTS["lang"].get(l, 1), up(2, (d, l))) for l in {k[1] for k in leaves if k[0] == d}])
        for l, b2 in mid.items():
            for s, b3 in deal(b2, [(k[2], 1, supply[k]) for k in leaves if k[:2] == (d, l)]).items():
                docs, e = leaves[d, l, s], 0
                while b3 > 0:
                    key = lambda x: (hashlib.sha256(f"{seed}:{e}:{'' if x[0] is None else x[0]}".encode()).hexdigest()[:15], x[0] is not None, x[0] or 0, x[1])  # noqa: B023, E731
                    for doc, n in sorted(docs, key=key):
                        if b3 > 0:
                            out.append((doc, d, l, s, e, n, min(n, b3)))
                            b3 -= n
                    e += 1
    return sorted(out, key=str)


def corpus(seed, n):
    r = random.Random(seed)
    data = []
    for i in range(n):
        source = r.choice(["a1", "a1", "a1", "a1", "a2", "b1", "b2", "c1", None])
        text = r.choice([" ", "\n"]).join("w%d" % r.randint(0, 9) for _ in range(r.choice([0, 1, 3, 10, 50])))
        data.append((i, text, r.choice(["en", "en", "de", "fr", None]), source))
    return data + [(n, None, "en", "a1"), (n + 1, "", "en", "a1"), (n + 2, "x " * 30000, "de", "b2"), (5, "again and again", "en", "a2"), (5, "again and again", "en", "a2"), (None, "no id", "en", "b1")]


def how(budget, epochs):
    weights = {k: mixing.weight_by(k, v) for k, v in WEIGHTS.items()} | {"source": F.lit(1)}
    return {"domain": F.substring("source", 1, 1), "weights": weights, "budget": budget, "epochs": epochs, "seed": 9}


@pytest.mark.parametrize(("budget", "epochs", "bucket"), [(0.3, 1, 2048), (1.0, 3, 4), (2.5, 4, 1), (50.0, 2, 3), (0.0, 1, 8)])
def test_against_plain_dealing(spark, monkeypatch, budget, epochs, bucket):
    monkeypatch.setattr(mixing, "BUCKET", bucket)
    data = corpus(3, 150)
    docs = spark.createDataFrame([(d, t, l, s, 0, "x") for d, t, l, s in data], "doc_id long, text string, lang string, source string, epoch int, leaf string")
    got = mixing.select_tokens(spark, docs, **how(budget, epochs)).drop("print").collect()
    assert sorted((tuple(x) for x in got), key=str) == brute(data, budget, epochs, 9)


def test_documents_keep_their_columns(spark):
    data = corpus(4, 60)
    docs = spark.createDataFrame([(t, d, l, s, 7) for d, t, l, s in data], "text string, doc_id long, lang string, source string, pick int")
    out = mixing.mixed_documents(spark, docs, **how(1.0, 2))
    assert out.columns == docs.columns
    want = brute(data, 1.0, 2, 9)
    rows = out.collect()
    assert sorted((str(x.doc_id), len(words(x.text))) for x in rows) == sorted((str(x[0]), x[6]) for x in want)
    texts = {(d, t) for d, t, *_ in data}
    assert sum((x.doc_id, x.text) not in texts for x in rows) <= sum(x[5] != x[6] for x in want)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert mixing.select_tokens(spark, docs, **how(1.0, 2)).count() == 0
    assert mixing.mixed_documents(spark, docs, **how(1.0, 2)).count() == 0

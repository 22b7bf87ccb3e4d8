"""Learned scores: scan against brute force, held-out accuracy, odd inputs."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from leafray.llm import labelled, quality, toxicity, words


def brute_segments(values):
    """Maximal scoring segments by their recursive definition."""
    out = []

    def part(lo, hi):
        best = None
        for i in range(lo, hi):
            total = 0.0
            for j in range(i, hi):
                total += values[j]
                if total > 1e-9 and (best is None or total > best[2] + 1e-9):
                    best = (i, j + 1, total)
        if best:
            out.append(best)
            part(lo, best[0])
            part(best[1], hi)

    part(0, len(values))
    return sorted(out)


def test_scan_finds_all_maximal_segments():
    r = random.Random(5)
    for _ in range(400):
        n = r.randint(0, 14)
        scores = [r.choice([0, 0, 0, 1.0, 2.3, 0.7, -1.1, -3.7]) + r.random() / 97 for _ in range(n)]
        places = [i for i, s in enumerate(scores) if abs(s) > 0.05]
        got = sorted(toxicity.maximal_segments(places, [scores[i] for i in places], 0.31))
        full = [(scores[i] if i in places else 0.0) - 0.31 for i in range(n)]
        want = brute_segments(full)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert np.allclose([g[2] for g in got], [w[2] for w in want])


def test_long_runs_stay_linear():
    n = 200_000
    assert toxicity.maximal_segments(list(range(n)), [1.0 if i % 2 else -0.9 for i in range(n)], 0.05)


@pytest.fixture(scope="module")
def corpus(spark):
    r = random.Random(11)
    vocabulary = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 6))) for _ in range(300)]
    docs, labels = [], []
    for i in range(900):
        words = [r.choice(vocabulary) for _ in range(r.randint(5, 80))]
        toxic, good = int(r.random() < 0.2), int(r.random() < 0.7)
        if toxic:
            for _ in range(1 + len(words) // 15):
                words.insert(r.randrange(len(words)), r.choice(["zork", "zonk", "blargh"]))
        text = " ".join(words)
        docs.append((i, text if good else text.upper() + "!!! $$$", 1.0, True))
        labels.append((i, good if i % 10 else None, toxic if i % 9 else None))
    docs += [(1000, None, 1.0, True), (1001, "", 1.0, True), (1001, "", 1.0, True), (None, "zork zork zork", 1.0, True), (1002, "zork " * 20000, 1.0, True), (1003, " \n", 1.0, True)]
    labels += [(None, 1, 1), (5, None, None), (5000, 1, 0)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, score double, held_out boolean"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


@pytest.mark.parametrize(("run", "label"), [(toxicity.scored, "toxic"), (quality.scored, "quality")])
def test_held_out_accuracy(spark, corpus, run, label):
    docs, labels = corpus
    out = run(spark, docs, labels)
    rows = out.collect()
    assert len(rows) == docs.count()
    assert all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.5) for x in rows)
    truth = {x.doc_id: x[label] for x in labels.collect() if x[label] is not None and x.doc_id is not None}
    held = [x for x in rows if x.held_out and x.doc_id in truth]
    assert len(held) > 100
    assert np.mean([x.predicted == truth[x.doc_id] for x in held]) > 0.95


def test_held_out_is_the_fold_and_never_learned(spark, corpus):
    docs, labels = corpus
    import zlib

    for x in toxicity.scored(spark, docs, labels).select("doc_id", "held_out").collect():
        assert x.held_out == (x.doc_id is not None and zlib.crc32(str(x.doc_id).encode()) % 5 == 0)
    few = labelled.sample(labels, "toxic", labelled.fold("doc_id", 5) != 0, 50).collect()
    assert len(few) == 50 and all(zlib.crc32(str(x.doc_id).encode()) % 5 for x in few)


def test_toxic_rows_go_and_columns_stay(spark, corpus):
    docs, labels = corpus
    out = toxicity.drop_toxic(docs, labels)
    assert out.columns == docs.columns
    kept = {x.doc_id for x in out.collect()}
    assert {1000, 1001, 1003} <= kept and 1002 not in kept and None not in kept


def test_softmax_equals_the_folded_score():
    model = quality.Model.fit(["good text here", "BAD TEXT", "fine words", "UGLY"] * 20, [1, 0, 1, 0] * 20)
    part, bias = model.folded()
    for t in ("good words", "BAD", "é x", ""):
        f, _ = quality.features(pa.array([t]))
        z = (model.vectors[f].mean(axis=0) if len(f) else np.zeros(quality.WIDTH)) @ model.output + model.bias
        p = np.exp(z - z.max())
        assert abs(p[1] / p.sum() - 1 / (1 + np.exp(-((part[f].mean() if len(f) else 0) + bias)))) < 1e-9


@pytest.mark.parametrize("run", [toxicity.scored, quality.scored])
def test_empty_tables(spark, corpus, run):
    docs, labels = corpus
    assert run(spark, docs.where(F.lit(False)), labels).count() == 0
    assert run(spark, docs, labels.where(F.lit(False))).count() == docs.count()


def plain_features(text):
    """Buckets of words and of character n-grams, by the definition."""
    t = "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "")
    out = []
    for w in t.split(" "):
        if w:
            out.append(int(words.Words(pa.array([w])).hashes()[0]) >> (64 - quality.WORD_BITS))
    for n in (3, 4):
        for i in range(len(t) - n + 1):
            gram = t[i : i + n]
            if " " not in gram[1:-1]:
                h = n
                for c in gram:
                    h = ((h ^ ord(c)) * 0x01000193) % 2**32
                out.append(((h * 0x9E3779B1) % 2**32 >> (32 - quality.GRAM_BITS)) + (1 << quality.WORD_BITS))
    return out


def test_quality_scores_against_the_definition(spark):
    model = quality.Model.fit(["good text here", "BAD TEXT", "fine wörds", "UGLY"] * 20, [1, 0, 1, 0] * 20)
    data = [(1, "good words"), (2, None), (3, ""), (4, " \n"), (5, "é x\tBAD  TEXT"), (None, "ab"), (5, "日本語 text"), (6, "fine " * 3000)]
    got = quality.score(spark.createDataFrame(data, "doc_id long, text string").coalesce(1), model).collect()
    for (d, t), x in zip(data, got, strict=True):
        f = plain_features(t)
        z = (model.vectors[f].mean(axis=0) if f else np.zeros(quality.WIDTH)) @ model.output + model.bias
        p = np.exp(z - z.max())
        assert x.doc_id == d and abs(x.score - p[1] / p.sum()) < 1e-9


def test_toxicity_scores_against_the_definition(spark):
    model = toxicity.Model({b"zork": 3.0, b"zonk": 2.1, b"calm": -2.5, b" blar": 2.7}, rate=0.4, k=0.3, slope=0.8, offset=-2.0)
    r = random.Random(3)
    data = [(i, " ".join(r.choice(["zork", "Zonk!", "calm", "blargh", "a", "b", "é"]) for _ in range(r.randint(0, 25)))) for i in range(60)] + [(99, None)]
    got = toxicity.score(spark.createDataFrame(data, "doc_id long, text string").coalesce(1), model).collect()
    for (d, t), x in zip(data, got, strict=True):
        tokens = toxicity.tokens(t)
        weight = [model.weights.get(w, 2.7 if w.startswith(b"blar") else 0.0) for w in tokens]
        rated = [(s, 0.3 * len(tokens) * np.exp(-0.4 * s)) for _, _, s in brute_segments([v - toxicity.DRIFT for v in weight])]
        best = max((s for s, _ in rated), default=0.0)
        counted = [(s, e) for s, e in rated if e < toxicity.SIGNIFICANT or abs(s - best) < 1e-9]
        want = 1 / (1 + np.exp(-(-2.0 + 0.8 * np.log1p(sum(1 / e for _, e in counted)))))
        assert x.doc_id == d and abs(x.score - want) < 1e-9
        assert len(x.passages) == sum(e < toxicity.SIGNIFICANT for _, e in rated)


def test_repeated_ids_stay_bounded(spark):
    """An id with very many rows brings neither all of them to the driver nor an error."""
    docs = spark.range(20_000).selectExpr("id % 40 as k", "id").selectExpr("case when k < 20 then 7 else k end as doc_id", "concat('zork text number ', id) as text")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    for run in (toxicity.scored, quality.scored):
        assert run(spark, docs, labels).count() == 20_000

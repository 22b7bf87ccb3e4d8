"""Toxicity by maximum-scoring segments.

Tokens are weighted by their log-odds of standing in toxic rather than clean
labelled texts, shrunk by an informative Dirichlet prior. A token whose own
log-odds aren't significant takes those of its longest significant prefix, or
else counts as background, which every token pays for with a small drift. A linear-time scan finds all maximal scoring segments of a text. Under
random clean text the best segment follows an extreme-value law (chance of
exceeding x about K n exp(-lambda x)), with lambda solved from the weights and
K fitted to clean texts; so each passage has an expected number of chance
occurrences E. A text's evidence sums 1 / E over its passages, and a logistic
curve over it, fitted to the labels, gives the score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafray.llm import labelled
from leafray.llm import words as words_

#: Labelled rows that are fitted on, at most.
SAMPLE = 20_000
#: Strength of the prior (pseudo-occurrences, and its least share of each token), least number of texts and least |z|
#: and least |log-odds| of a weighted token, cost of any token.
PRIOR, FLOOR, LEAST, Z, EFFECT, DRIFT = 500.0, 0.5, 4, 3.0, 1.5, 0.05
#: Lengths in bytes of the prefixes that stand in for rare tokens. A prefix is written with a leading space.
PREFIXES = (8, 7, 6, 5, 4)
#: Tokens whose weight a worker remembers before it starts anew.
MEMO = 50_000
#: Bytes of text whose tokens are counted before they are sent on.
COUNTED = 1 << 23
#: A passage is significant if chance gives fewer than this many in a text.
SIGNIFICANT = 0.05

#: From bytes to bytes: A-Z in lower case, and a space for every other ASCII character that is no letter or digit.
SEPARATED = bytes(c + 32 if 65 <= c <= 90 else c if chr(c).isalnum() and c < 128 or c >= 128 else 32 for c in range(256))


def tokens(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of all non-ASCII characters, A-Z in lower case."""
    return (text or "").encode().translate(SEPARATED).split()


def maximal_segments(places: list[int], scores: list[float], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (begin, end, score) of a sequence that scores ``scores`` at ``places`` and 0 elsewhere, less ``drift`` everywhere.

    Ruzzo and Tompa's scan; every candidate remembers the nearest earlier one
    with a smaller sum to its left, which keeps the search linear.
    """
    found: list[tuple[int, int, float, float, int]] = []  # begin, end, sum to the left, sum with it, nearest smaller
    total, at = 0.0, 0
    for place, score in zip(places, scores, strict=True):
        total -= drift * (place - at)
        at = place + 1
        left, total = total, total + score - drift
        if total <= left:
            continue
        begin, right = place, total
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= left:
                j = found[j][4]
            if j < 0 or found[j][3] >= right:
                found.append((begin, place + 1, left, right, j))
                break
            begin, left, j, at_j = found[j][0], found[j][2], found[j][4], j
            del found[at_j:]
    return [(b, e, r - l) for b, e, l, r, _ in found]


class _Weights(dict):
    """Weight of each token met, 0 for background."""

    def __init__(self, known: dict[bytes, float]):
        super().__init__()
        self.known = known

    def __missing__(self, token: bytes) -> float:
        if len(self) >= MEMO:
            self.clear()
        w = self.known.get(token)
        if w is None:
            w = next((x for k in PREFIXES if len(token) > k and (x := self.known.get(b" " + token[:k])) is not None), 0.0)
        self[token] = w
        return w


@dataclass
class Model:
    weights: dict[bytes, float] = field(default_factory=dict)
    rate: float = 1.0
    k: float = 1.0
    slope: float = 1.0
    offset: float = -3.0
    memo: _Weights | None = None

    def __getstate__(self):
        return self.__dict__ | {"memo": None}

    def passages(self, words: list[bytes]) -> list[tuple[int, int, float, float]]:
        """Significant passages (begin, end, score, E) of a text's tokens, and the best one in any case."""
        if self.memo is None:
            self.memo = _Weights(self.weights)
        w = self.memo
        places = [i for i, t in enumerate(words) if w[t]]
        segments = maximal_segments(places, [w[words[i]] for i in places], DRIFT)
        rated = [(b, e, s, self.k * len(words) * float(np.exp(-self.rate * s))) for b, e, s in segments]
        best = max((r[2] for r in rated), default=0.0)
        return [r for r in rated if r[3] < SIGNIFICANT or r[2] == best]

    def evidence(self, words: list[bytes]) -> float:
        return float(np.log1p(sum(1.0 / max(e, 1e-300) for *_, e in self.passages(words))))

    def score(self, text: str | None) -> float:
        return float(1.0 / (1.0 + np.exp(-(self.offset + self.slope * self.evidence(tokens(text))))))


def _counts(train: DataFrame) -> DataFrame:
    """Of (text, label, half), per half and token or prefix: the toxic and clean texts that hold it, its occurrences in clean ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words_.pieces(batches, "text", COUNTED):
            seen = [(Counter(), Counter(), Counter()) for _ in range(2)]
            for text, label, half in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                words = tokens(text)
                keys = [[w, *(b" " + w[:k] for k in PREFIXES if len(w) > k)] for w in words]
                seen[half][label].update({k for ks in keys for k in ks})
                if not label:
                    seen[half][2].update(k for ks in keys for k in ks)
            for half, (clean, toxic, n) in enumerate(seen):
                names = list({*clean, *toxic})
                counts = [pa.array([c[k] for k in names], pa.int64()) for c in (toxic, clean, n)]
                yield pa.RecordBatch.from_arrays([pa.array([half] * len(names), pa.int32()), pa.array(names, pa.binary()), *counts], names=["half", "token", "toxic", "clean", "n"])

    counted = train.select("text", "label", "half").mapInArrow(run, "half int, token binary, toxic long, clean long, n long")
    return counted.groupBy("half", "token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.sum("n").alias("n"))


def _weighted(counts: DataFrame) -> Model:
    """A model whose weights and rate come from counts (token, toxic, clean, n)."""
    whole = counts.where(F.substring(F.col("token"), 1, 1) != F.lit(b" "))
    toxic, clean, n = whole.agg(F.sum("toxic"), F.sum("clean"), F.sum("n")).first()
    model = Model()
    if toxic and clean:
        prior = PRIOR * (F.col("toxic") + F.col("clean")) / float(toxic + clean) + FLOOR
        yt, yc = F.col("toxic") + prior, F.col("clean") + prior
        odds = F.ln(yt / (toxic + PRIOR)) - F.ln(yc / (clean + PRIOR))
        rated = counts.where(F.col("toxic") + F.col("clean") >= LEAST).select("token", "n", odds.alias("odds"), (odds / F.sqrt(1 / yt + 1 / yc)).alias("z"))
        # no more rows than the bounded sample has tokens, over LEAST
        kept = rated.where((F.abs("z") >= Z) & (F.abs("odds") >= EFFECT)).orderBy("token").collect()
        weights = np.array([r.odds for r in kept])
        if (weights > DRIFT).any():
            model.weights = {bytes(r.token): r.odds for r in kept}
            model.rate = _rate(weights, np.array([r.n + FLOOR for r in kept]) / (n + FLOOR * len(kept)))
    return model


def _rate(weights: np.ndarray, share: np.ndarray) -> float:
    """The positive root of sum(share * exp(rate * weight)) = 1, with the rest of the share at -DRIFT."""

    def excess(x: float) -> float:
        return float((share * np.exp(x * (weights - DRIFT))).sum() + (1 - share.sum()) * np.exp(-x * DRIFT) - 1)

    share = share / max(1.0, 2 * share.sum())  # prefixes count again what their tokens count
    low, high = 1e-6, 1e-3
    while excess(high) < 0 and high < 64:
        low, high = high, high * 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return high


def fit(docs: DataFrame, sample: DataFrame) -> Model:
    """A model from ``docs`` (doc_id, text) and a bounded ``sample`` of labels (doc_id, label 0 or 1).

    The extreme-value law and the logistic curve are fitted to texts that the
    weights have not seen: each half of the sample is rated with the weights of
    the other. Without texts of both kinds, or without a significant token, the
    model has no weights and scores every text by the share of toxic labels.
    """
    sample = sample.select(F.col("doc_id").alias("sample_id"), "label", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("half")).cache()
    train = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("sample_id"))
    counts = _counts(train).cache()
    halves = [_weighted(counts.where(F.col("half") == 1 - h)) for h in range(2)]
    model = _weighted(counts.groupBy("token").agg(*[F.sum(c).alias(c) for c in ("toxic", "clean", "n")]))
    counts.unpersist()

    def rate(of: list[Model]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in words_.pieces(batches, "text"):
                found = []
                for text, label, half in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                    words = tokens(text)
                    best = max((s for _, _, s, _ in of[half].passages(words)), default=0.0)
                    found.append((label, half, len(words), best, of[half].evidence(words)))
                columns = list(zip(*found, strict=True)) or [()] * 5
                types = (pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types, strict=True)], names=["label", "half", "n", "best", "evidence"])

        return train.select("text", "label", "half").mapInArrow(run, "label int, half int, n long, best double, evidence double")

    chance = F.sum(F.col("n") * F.exp(-F.when(F.col("half") == 0, halves[0].rate).otherwise(halves[1].rate) * F.col("best")))
    of_clean = rate(halves).where("label = 0 and n > 0").agg(F.count(F.lit(1)), chance).first()
    if of_clean[0] and of_clean[1]:
        halves[0].k = halves[1].k = model.k = of_clean[0] / of_clean[1]
    # counted by hundredths of evidence (which ends below 800), so that ids with many rows bring no more points;
    # sorted, so that the fit doesn't depend on the order in which tasks end
    points = sorted(tuple(r) for r in rate(halves).groupBy("label", F.round("evidence", 2)).count().collect())
    label, evidence, times = np.array(points, float).reshape(-1, 3).T
    model.slope, model.offset = _logistic(evidence, label, times)
    sample.unpersist()
    return model


def _logistic(x: np.ndarray, y: np.ndarray, times: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve over points that count ``times``, by Newton steps with a slight ridge."""
    if not len(y):
        return 0.0, -3.0
    design, beta = np.stack([x, np.ones_like(x)], 1), np.zeros(2)

    def loss(b: np.ndarray) -> float:
        z = design @ b
        return float(times @ (np.logaddexp(0, z) - z * y) + 5e-4 * b @ b)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        curve = (design * (times * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, design.T @ (times * (y - p)) - 1e-3 * beta)
        while loss(beta + step) > loss(beta) and np.abs(step).max() > 1e-9:
            step /= 2
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return float(max(beta[0], 0.0)), float(beta[1])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1), passages (array of begin, end, score, e in tokens) for every row; null counts as empty, and an empty table gives an empty result."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("passages", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("e", pa.float64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words_.pieces(batches, "text"):
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = tokens(text)
                found = model.passages(words)
                x = float(np.log1p(sum(1.0 / max(e, 1e-300) for *_, e in found)))
                p = float(1.0 / (1.0 + np.exp(-(model.offset + model.slope * x))))
                out.append({"doc_id": doc_id, "score": p, "passages": [{"begin": b, "end": e, "score": s, "e": v} for b, e, s, v in found if v < SIGNIFICANT]})
            yield pa.RecordBatch.from_pylist(out, schema)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, passages array<struct<begin:long,end:long,score:double,e:double>>")


def scored(spark: SparkSession, docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted, n_passages for every row of ``docs``.

    Only labels of ids whose fold isn't ``held`` are learned from, SAMPLE of
    them at most. A null id is in no fold. Empty tables give empty results;
    columns other than doc_id, text and toxic are ignored.
    """
    model = fit(docs, labelled.sample(labels, "toxic", labelled.fold("doc_id", folds) != held, SAMPLE))
    out = score(docs, model)
    held_out = F.coalesce(labelled.fold("doc_id", folds) == held, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))


def drop_toxic(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """``docs`` without the texts that score 0.5 or more; rows are judged in place, all columns as they are.

    Null and empty texts are judged like any text without tokens; repeated rows
    share their fate; an empty table gives an empty result.
    """
    model = fit(docs, labelled.sample(labels, "toxic", labelled.fold("doc_id", folds) != held, SAMPLE))
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words_.pieces(batches, "text"):
            yield batch.filter(pa.array([model.score(t) < 0.5 for t in batch.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

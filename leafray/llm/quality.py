"""Quality classifier with supervised subword embeddings.

A text is the average of learned vectors of its words and of its character
n-grams (three and four characters of one word, or of a word and the white space
next to it), all hashed to a fixed number of buckets; a softmax over the average gives
the two labels. Vectors and output weights are trained together by stochastic
gradient descent in numpy on a bounded sample. The softmax of two labels
depends on the difference of their outputs only, which is linear in the
average; so each bucket's part of it is computed once, and scoring a text
averages those numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafray.llm import labelled, words

#: Labelled rows and bytes of text that are fitted on, at most.
SAMPLE, SAMPLE_BYTES = 6_000, 48_000_000
#: What a row counts besides its text.
ROW_BYTES = 64
#: Buckets of words and of n-grams, width of vectors, passes over the sample, first step.
WORD_BITS, GRAM_BITS, WIDTH, EPOCHS, STEP = 16, 17, 8, 4, 0.5


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and n-grams of the texts, repeats included, and which text each belongs to."""
    w = words.Words(texts)
    strings = ["" if t is None else t for t in texts.to_pylist()]
    chars = np.frombuffer("".join(strings).encode("utf-32-le"), np.uint32)
    space = (chars == 32) | ((chars >= 9) & (chars <= 13))
    chars = np.where(space, np.uint32(32), chars)
    text = np.repeat(np.arange(len(strings)), [len(t) for t in strings])
    buckets, owners = [(w.hashes() >> np.uint64(64 - WORD_BITS)).astype(np.int64)], [np.repeat(np.arange(len(strings)), w.counts())]
    for n in (3, 4):
        size = max(0, len(chars) - n + 1)
        h = np.full(size, n, np.uint32)
        inner = text[:size] == text[len(text) - size :]
        for j in range(n):
            h = (h ^ chars[j : j + size]) * np.uint32(0x01000193)
            if 0 < j < n - 1:
                inner &= ~space[j : j + size]
        h *= np.uint32(0x9E3779B1)
        buckets.append((h >> np.uint32(32 - GRAM_BITS))[inner].astype(np.int64) + (1 << WORD_BITS))
        owners.append(text[:size][inner])
    return np.concatenate(buckets), np.concatenate(owners)


@dataclass
class Model:
    vectors: np.ndarray
    output: np.ndarray
    bias: np.ndarray

    @classmethod
    def fit(cls, texts: list[str], labels: list[int], seed: int = 7) -> Model:
        r = np.random.default_rng(seed)
        vectors = r.uniform(-1 / WIDTH, 1 / WIDTH, ((1 << WORD_BITS) + (1 << GRAM_BITS), WIDTH))
        output, bias = np.zeros((WIDTH, 2)), np.zeros(2)
        bags = []
        for t, y in zip(texts, labels, strict=True):
            bucket, count = np.unique(features(pa.array([t], pa.string()))[0], return_counts=True)
            if len(bucket):
                bags.append((bucket, count / count.sum(), y))
        step, total, done = STEP, max(1, EPOCHS * len(bags)), 0
        for _ in range(EPOCHS):
            for k in r.permutation(len(bags)):
                bucket, share, y = bags[k]
                hidden = share @ vectors[bucket]
                z = hidden @ output + bias
                p = np.exp(z - z.max())
                p /= p.sum()
                p[y] -= 1.0
                step = STEP * (1 - done / total)
                done += 1
                back = output @ p
                output -= step * np.outer(hidden, p)
                bias -= step * p * 0.1
                # a bag's shares are small; scaled to unit length they move the vectors as much as the output
                vectors[bucket] -= step * np.outer(share / np.sqrt((share**2).sum()), back)
        return cls(vectors, output, bias)

    def folded(self) -> tuple[np.ndarray, float]:
        """Each bucket's part in the difference of the two outputs, and that of the bias."""
        return (self.vectors @ (self.output[:, 1] - self.output[:, 0])).astype(np.float64), float(self.bias[1] - self.bias[0])


def fit(docs: DataFrame, sample: DataFrame) -> Model:
    """A model from a bounded ``sample`` of labels (doc_id, label): at most SAMPLE rows and SAMPLE_BYTES of whole texts.

    An id counts with all rows that repeat it, and is left out if they are too
    many. Without rows the model's output is zero everywhere (score one half).
    """
    sample = sample.select(F.col("doc_id").alias("sample_id"), "label").cache()
    own = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("sample_id"))
    sizes = own.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).alias("size")).groupBy("doc_id").agg(F.sum("size").alias("size")).orderBy(F.xxhash64("doc_id", F.lit(17)), "doc_id").collect()
    chosen, used = [], 0
    for row in sizes:
        if used + row["size"] <= SAMPLE_BYTES:
            chosen.append((row.doc_id,))
            used += row["size"]
    few = docs.sparkSession.createDataFrame(chosen, "chosen long")
    rows = own.join(F.broadcast(few), F.col("doc_id") == F.col("chosen"), "left_semi").select("doc_id", "label", "text").collect()
    sample.unpersist()
    rows = sorted(rows, key=lambda x: (x.doc_id, x.text or ""))
    return Model.fit([x.text or "" for x in rows], [x.label for x in rows])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (chance of label 1) for every row; a text without features (null, empty) scores by the bias alone; an empty table gives an empty result."""
    part, bias = model.folded()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in words.pieces(batches, "text"):
            bucket, owner = features(piece.column("text"))
            n = np.bincount(owner, minlength=piece.num_rows)
            z = np.bincount(owner, part[bucket], piece.num_rows) / np.maximum(n, 1) + bias
            p = 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(p, pa.float64())], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def scored(spark: SparkSession, docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Only labels of ids whose fold isn't ``held`` are learned from. A null id is
    in no fold; null text counts as empty. Empty tables give empty results;
    columns other than doc_id, text and quality are ignored.
    """
    model = fit(docs, labelled.sample(labels, "quality", labelled.fold("doc_id", folds) != held, SAMPLE))
    held_out = F.coalesce(labelled.fold("doc_id", folds) == held, F.lit(False))
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

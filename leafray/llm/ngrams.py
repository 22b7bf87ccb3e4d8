"""Stupid-backoff scores with counts of any vocabulary: no bound on tokens or n-grams, none left out for being rare.

Tokens are runs of ASCII letters and digits and of non-ASCII characters, A-Z in
lower case. For a k-gram g = (context, w), S = c(g) / c(context) where c(g) > 0,
else BACKOFF * S of the shorter one, down to max(c(w), 1) / N. A text's first
tokens have the contexts that the text has. The counts c are those of the whole
corpus; with ``leave_out``, less those of the scored text itself (and N less its
tokens), so that a text is judged by all others: its own copy of a rare passage
does not vouch for it, and what no other text says backs off.

Documents are tokenised once, into batches of about BATCH tokens. A batch asks
for the counts of its distinct n-grams: their 64-bit hashes, sorted and cut by
range into buckets, go with the batch's own counts to the bucket, which adds up
all batches and answers each in the order of its question. So the count table is
partitioned by hash, a key travels once per batch however often it occurs, no
key is hot, and what a task holds is a batch or a bucket (about BUCKET entries)
whatever the input. Pairs are asked with the tokens; longer n-grams in rounds of
their own, and only where both n-grams one shorter inside them occur elsewhere,
since otherwise the n-gram doesn't either.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafray.llm import toxicity, words
from leafray.llm.common import materialize, shared_dir

BACKOFF = 0.4
BATCH, BUCKET, LEAST_BUCKETS = 1 << 20, 1 << 21, 256
STATE = "batch long, n_tokens long, doc_ids array<long>, lengths array<int>, vocabulary binary, ranks binary, sequence binary"
ASKED = "bucket long, batch long, keys binary, n binary"


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers, compressed byte plane by byte plane; the first byte is how many planes the largest needs. None are no bytes."""
    if not len(values):
        return b""
    width = max(1, (int(values.max()).bit_length() + 7) // 8)
    raw = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
    return bytes([width]) + len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    if not data:
        return np.empty(0, np.int64)
    raw = pa.Codec("zstd").decompress(data[9:], decompressed_size=int.from_bytes(data[1:9], "little"), asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : data[0]] = planes.T
    return out.view("<i8").reshape(-1)


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data).view(np.uint64), dtype=np.uint64)


def _batches(docs: DataFrame) -> DataFrame:
    """The documents as token sequences (STATE), one row per batch."""
    table = np.frombuffer(toxicity.SEPARATED, np.uint8)

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        ids, lengths, found, held, made = [], [], [], 0, 0

        def row() -> pa.RecordBatch:
            vocabulary, sequence, n = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
            # stored by rank, so that frequent tokens take few bits
            ranked = np.argsort(-n, kind="stable")
            rank = np.empty_like(ranked)
            rank[ranked] = np.arange(len(ranked))
            values = [first + made, held, ids, lengths, pack_sorted(vocabulary), pack(rank), pack(rank[sequence])]
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=[c.split()[0] for c in STATE.split(", ")])

        for piece in words.pieces(arrow, "text"):
            w = words.Words(piece.column("text"), table)
            found.append(w.hashes())
            ids += piece.column("doc_id").to_pylist()
            lengths += w.counts().tolist()
            held += len(found[-1])
            if held >= BATCH or len(ids) >= BATCH:
                yield row()
                ids, lengths, found, held, made = [], [], [], 0, made + 1
        if ids:
            yield row()

    return docs.select("doc_id", "text").mapInArrow(run, STATE)


class _Batch:
    """One row of STATE, and the counts of its n-grams as far as they have been answered."""

    def __init__(self, row: dict, leave_out: bool, answers: Sequence[tuple[int, bytes]] = ()):
        self.ids, self.lengths = row["doc_ids"], np.array(row["lengths"], np.int64)
        vocabulary = unpack_sorted(row["vocabulary"])
        self.h = vocabulary[np.argsort(unpack(row["ranks"]))[unpack(row["sequence"])]]
        self.document = np.repeat(np.arange(len(self.lengths), dtype=np.int32), self.lengths)
        ends = np.cumsum(self.lengths)
        self.place = (np.arange(len(self.h)) - np.repeat(ends - self.lengths, self.lengths)).astype(np.int32)
        self.leave_out = leave_out
        #: The count that is known without asking: an n-gram with a rarer part occurs here only.
        self.floor = 0 if leave_out else 1
        #: By order, the count of the n-gram that begins at each place.
        self.counts: dict[int, np.ndarray] = {}
        parts = [unpack(c) for _, c in sorted(answers)]
        answered = np.concatenate(parts) if parts else np.empty(0, np.int64)
        at, k = 0, 1
        while at < len(answered):
            here, distinct, which, _ = self.grams(k)
            corpus = answered[at : at + len(distinct)]
            at += len(distinct)
            self.counts[k] = np.full(len(self.h), self.floor, np.int64)
            self.counts[k][here] = corpus[which] - (self._own(here, which, len(distinct)) if leave_out else 0)
            k += 1

    def _own(self, here: np.ndarray, which: np.ndarray, n: int) -> np.ndarray:
        """How often each occurrence's n-gram occurs in its document."""
        _, code, times = np.unique(self.document[here] * np.int64(n) + which, return_inverse=True, return_counts=True)
        return times[code]

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Places where k-grams begin whose corpus count is asked for, their sorted distinct hashes, which of these each is, and how often each occurs."""
        n = len(self.h) - k + 1
        inside = self.document[: max(n, 0)] == self.document[k - 1 :]
        if k > 2 and n > 0:
            shorter = self.counts.get(k - 1, np.full(len(self.h), self.floor))
            inside &= (shorter[:n] > self.floor) & (shorter[1 : n + 1] > self.floor)
        here = np.flatnonzero(inside)
        keys = self.h if k == 1 else words.runs(self.h, k)[here]
        return here, *np.unique(keys, return_inverse=True, return_counts=True)

    def question(self, number: int, orders: Sequence[int], buckets: int) -> Iterator[pa.RecordBatch]:
        """The distinct n-grams of ``orders`` by bucket (ASKED); each order has ``buckets`` of its own."""
        edges = np.array([(i << 64) // buckets for i in range(buckets)], np.uint64)
        for k in orders:
            _, keys, _, n = self.grams(k)
            cut = np.append(np.searchsorted(keys, edges), len(keys))
            full = np.flatnonzero(np.diff(cut))
            parts = [slice(cut[i], cut[i + 1]) for i in full]
            columns = [pa.array(full + k * buckets, pa.int64()), pa.array([number] * len(full), pa.int64()), pa.array([pack_sorted(keys[p]) for p in parts], pa.binary()), pa.array([pack(n[p]) for p in parts], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "batch", "keys", "n"])

    def scores(self, order: int, total: int) -> np.ndarray:
        """The log-score of each document."""
        rest = total - (self.lengths if self.leave_out else 0 * self.lengths)
        score = np.log(np.maximum(self.counts[1], 1)) - np.log(np.maximum(rest, 1))[self.document] if len(self.h) else np.empty(0)
        for k in range(2, order + 1):
            ends = np.flatnonzero(self.place >= k - 1)
            begins = ends - (k - 1)
            n, context = (self.counts[j][begins] if j in self.counts else np.full(len(ends), self.floor) for j in (k, k - 1))
            score[ends] = np.where(n > 0, np.log(np.maximum(n, 1)) - np.log(np.maximum(context, 1)), np.log(BACKOFF) + score[ends])
        return np.bincount(self.document, score, len(self.ids)).astype(np.float64)


def _answers(asked: DataFrame) -> DataFrame:
    """(batch, bucket, counts): the corpus counts of the n-grams that a batch asked a bucket for, in their order."""

    def add(table: pa.Table) -> pa.Table:
        keys = [unpack_sorted(k) for k in table["keys"].to_pylist()]
        n = np.concatenate([unpack(x) for x in table["n"].to_pylist()])
        distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(which, n, len(distinct)).astype(np.int64)
        each = np.split(total[which], np.cumsum([len(k) for k in keys])[:-1])
        return pa.table({"batch": table["batch"], "bucket": table["bucket"], "counts": pa.array([pack(x) for x in each], pa.binary())})

    return asked.groupBy("bucket").applyInArrow(add, "batch long, bucket long, counts binary")


def _known(left: pa.Table, right: pa.Table, leave_out: bool) -> _Batch:
    return _Batch(left.to_pylist()[0], leave_out, list(zip(right["bucket"].to_pylist(), right["counts"].to_pylist(), strict=True)))


def scores(spark: SparkSession, docs: DataFrame, order: int = 3, leave_out: bool = False) -> DataFrame:
    """doc_id, n_tokens, log_score (natural log, summed) and mean_log_score for every row of ``docs``.

    A text without tokens (null, empty, punctuation) scores 0 with a null mean.
    Repeated rows are counted and scored as often as they occur; with
    ``leave_out`` each is left out by itself. Columns other than doc_id and text
    are ignored. An empty table gives an empty result.
    """
    root = shared_dir(spark, "ngrams")
    state = materialize(_batches(docs), f"{root}/batches")
    total = state.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    buckets = max(LEAST_BUCKETS, total // BUCKET)

    def ask_first(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow:
            for row in batch.to_pylist():
                yield from _Batch(row, leave_out).question(row["batch"], range(1, min(order, 2) + 1), buckets)

    def ask(k: int):
        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            number = left["batch"][0].as_py()
            return pa.Table.from_batches(list(_known(left, right, leave_out).question(number, [k], buckets)))

        return run

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        batch = _known(left, right, leave_out)
        return pa.table({"doc_id": pa.array(batch.ids, pa.int64()), "n_tokens": pa.array(batch.lengths), "log_score": pa.array(batch.scores(order, total))})

    answers = _answers(state.mapInArrow(ask_first, ASKED))
    met = lambda: state.groupBy("batch").cogroup(answers.groupBy("batch"))
    for k in range(3, order + 1):
        answers = materialize(answers, f"{root}/answers{k - 1}")
        answers = answers.unionByName(_answers(met().applyInArrow(ask(k), ASKED)))
    out = met().applyInArrow(score, "doc_id long, n_tokens long, log_score double")
    return out.select("doc_id", "n_tokens", "log_score", F.expr("try_divide(log_score, n_tokens)").alias("mean_log_score"))


_TOKENS = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
k AS (SELECT r, len(w) AS n, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM t),
b AS (SELECT r, n, i, w, lag(w) OVER s AS p, lag(w, 2) OVER s AS q FROM k WINDOW s AS (PARTITION BY r ORDER BY i)),"""
_SCORED = r"""
SELECT doc_id, len(t.w)::BIGINT AS n_tokens, round(coalesce(g, 0.0), 6) AS log_score, round(g / nullif(len(t.w), 0), 6) AS mean_log_score
FROM t LEFT JOIN s USING (r)
"""

#: Three orders, each text counted with all others. The texts scored are those counted, so every n-gram is known and no score backs off.
SQL = _TOKENS + r"""
c1 AS (SELECT w, count(*) AS c FROM k GROUP BY w),
c2 AS (SELECT p, w, count(*) AS c FROM b WHERE p IS NOT NULL GROUP BY p, w),
c3 AS (SELECT q, p, w, count(*) AS c FROM b WHERE q IS NOT NULL GROUP BY q, p, w),
s AS (SELECT b.r, sum(CASE WHEN b.q IS NOT NULL THEN ln(c3.c / cp.c::DOUBLE) WHEN b.p IS NOT NULL THEN ln(c2.c / u.c::DOUBLE)
    ELSE ln(c1.c / (SELECT count(*) FROM k)::DOUBLE) END) AS g
    FROM b JOIN c1 ON c1.w = b.w LEFT JOIN c1 u ON u.w = b.p LEFT JOIN c2 ON c2.p = b.p AND c2.w = b.w LEFT JOIN c2 cp ON cp.p = b.q AND cp.w = b.p
    LEFT JOIN c3 ON c3.q = b.q AND c3.p = b.p AND c3.w = b.w GROUP BY b.r)""" + _SCORED

#: Three orders, each text scored by all other texts.
LEFT_OUT_SQL = _TOKENS + rf"""
c AS (SELECT r, n, i, p, q, count(*) OVER (PARTITION BY w) - count(*) OVER (PARTITION BY r, w) AS n1,
    CASE WHEN p IS NOT NULL THEN count(*) OVER (PARTITION BY p, w) - count(*) OVER (PARTITION BY r, p, w) END AS n2,
    CASE WHEN q IS NOT NULL THEN count(*) OVER (PARTITION BY q, p, w) - count(*) OVER (PARTITION BY r, q, p, w) END AS n3 FROM b),
m AS (SELECT *, lag(n1) OVER s AS m1, lag(n2) OVER s AS m2, ln(greatest(n1, 1) / greatest((SELECT count(*) FROM k) - n, 1)::DOUBLE) AS s1 FROM c WINDOW s AS (PARTITION BY r ORDER BY i)),
d AS (SELECT *, CASE WHEN n2 > 0 THEN ln(n2 / m1::DOUBLE) WHEN p IS NOT NULL THEN ln({BACKOFF}) + s1 ELSE s1 END AS s2 FROM m),
s AS (SELECT r, sum(CASE WHEN n3 > 0 THEN ln(n3 / m2::DOUBLE) WHEN q IS NOT NULL THEN ln({BACKOFF}) + s2 ELSE s2 END) AS g FROM d GROUP BY r)""" + _SCORED

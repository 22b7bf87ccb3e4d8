"""Hard negatives of anchors, scored by Kronecker-packed products.

Vectors hold whole numbers. Components of a block of candidates are biased to
be non-negative and several candidates share one wide number per dimension, each
in a field wide enough for its whole inner product. One multiplication by an
anchor's component then serves all of them, no field runs over into the next,
and the exact scores are read off the fields. Wide numbers are carried in the 53
exact bits of a double, so that a matrix product does the multiplying; rows too
large for that are packed into Python's integers, which have no bound.

Anchors and candidates are packed into blocks of bounded size. A first pass over
the blocks that share a label finds each anchor's positives, a second one over
all blocks the candidates in the windows that their scores open. A task sees one
block of candidates and a bounded number of anchor blocks; what it returns is a
few rows per anchor.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 (pa.compute)
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafray.llm.common import materialize, shared_dir

#: Most candidates and anchors of a block, anchor blocks that a task takes (about), and anchors scored at once.
CANDIDATES, ANCHORS, TOGETHER, SLICE = 16_384, 1_024, 16, 128
#: Bits of a double that are exact, and candidates in one of Python's integers.
DOUBLE_BITS, WIDE = 53, 256
_LEAST, _MOST = -(2**63), 2**63 - 1


def _biased(m: np.ndarray) -> tuple[np.ndarray, int]:
    low = int(m.min()) if m.size else 0
    return m - low, low


def field_bits(a: np.ndarray, c: np.ndarray) -> int:
    """Bits that hold every component of ``c`` and every inner product of a row of it and a row of ``a``, all non-negative."""
    most = a.shape[1] * max(1, int(a.max()) if a.size else 0) * (int(c.max()) if c.size else 0)
    return max(1, most.bit_length())


def packed_products(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products of all ``anchors`` and ``candidates`` (integer matrices, a vector per row), a long each.

    Products beyond a long are returned as the nearest long.
    """
    a, low_a = _biased(anchors)
    c, low_c = _biased(candidates)
    bits = field_bits(a, c)
    dims = anchors.shape[1]
    if bits <= DOUBLE_BITS and anchors.dtype != object and candidates.dtype != object:
        fields = DOUBLE_BITS // bits
        n = -(-len(c) // fields)
        wide = np.zeros((dims, n))
        for f in range(fields):
            part = c[f * n : (f + 1) * n]
            wide[:, : len(part)] += part.T * float(1 << (f * bits))
        products = (a.astype(np.float64) @ wide).astype(np.int64)
        out = np.empty((len(a), len(c)), np.int64)
        for f in range(fields):
            to = out[:, f * n : (f + 1) * n]
            to[:] = (products[:, : to.shape[1]] >> (f * bits)) & ((1 << bits) - 1)
        # bits leave room for the corrections: each is at most a product of 53 bits
        out += low_c * a.sum(1, dtype=np.int64)[:, None] + low_a * candidates.sum(1, dtype=np.int64)[None, :]
        return out
    rows_a, rows_c = [[int(x) for x in r] for r in a], [[int(x) for x in r] for r in c]
    octets = -(-bits // 8)
    fix_a, fix_c = [low_c * sum(r) for r in rows_a], [low_a * (sum(r) + dims * low_c) for r in rows_c]
    out = np.empty((len(a), len(c)), np.int64)
    for at in range(0, len(rows_c), WIDE):
        part = rows_c[at : at + WIDE]
        wide = [int.from_bytes(b"".join(r[d].to_bytes(octets, "little") for r in part), "little") for d in range(dims)]
        for i, row in enumerate(rows_a):
            whole = sum(x * w for x, w in zip(row, wide, strict=True)).to_bytes(octets * len(part), "little")
            for j in range(len(part)):
                score = int.from_bytes(whole[j * octets : (j + 1) * octets], "little") + fix_a[i] + fix_c[at + j]
                out[i, at + j] = min(max(score, _LEAST), _MOST)
    return out


def scores(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products; rows of small components are packed apart from the others, so that a large row slows no other."""
    out = np.empty((len(anchors), len(candidates)), np.int64)
    for rows, a in _by_size(anchors):
        for columns, c in _by_size(candidates):
            out[np.ix_(rows, columns)] = packed_products(a, c)
    return out


def _by_size(m: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The rows that two to a double hold with any other such row, and the rest, as longs if products fit into them."""
    most = np.array([max(map(abs, r), default=0) for r in m], object) if m.dtype == object else np.abs(m).max(axis=1, initial=0)
    dims = max(1, m.shape[1])
    small = (most <= math.isqrt((1 << 26) // dims) // 2).astype(bool)
    out = [(np.flatnonzero(small), m[small].astype(np.int64))]
    if not small.all():
        rest = m[~small]
        out.append((np.flatnonzero(~small), rest.astype(np.int64 if int(most.max()) ** 2 * dims < 1 << 62 else object)))
    return [x for x in out if len(x[0])]


def best(score: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the ``k`` best allowed scores of each row; ties go to the smaller column."""
    if score.shape[1] > k and np.count_nonzero(allowed) > len(score) * 4 * k:
        held = np.where(allowed, score, _LEAST)
        edge = np.partition(held, held.shape[1] - k, axis=1)[:, held.shape[1] - k]
        allowed = allowed & (score >= edge[:, None])
    row, column = np.nonzero(allowed)
    order = np.lexsort((column, ~score[row, column], row))
    row, column = row[order], column[order]
    if not len(row):
        return row, column
    begins = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    place = np.arange(len(row)) - np.repeat(begins, np.diff(np.append(begins, len(row))))
    return row[place < k], column[place < k]


def _saved(**arrays: np.ndarray) -> bytes:
    to = io.BytesIO()
    np.savez(to, **arrays)
    return to.getvalue()


def _whole(values: np.ndarray) -> np.ndarray:
    """Whole numbers held in doubles as 16-bit numbers where they fit, else as long, else left as doubles."""
    most = np.abs(values).max(initial=0)
    return values.astype(np.int16) if most < 1 << 15 else values.astype(np.int64) if most < 2.0**62 else values


def _opened(payload: bytes) -> dict[str, np.ndarray]:
    found = dict(np.load(io.BytesIO(payload)))
    v = found["vector"]
    found["vector"] = np.array([[int(x) for x in r] for r in v], object).reshape(v.shape) if v.dtype == np.float64 else v.astype(np.int64)
    return found


def _blocks(rows: DataFrame, most: int, total: int) -> DataFrame:
    """``rows`` (node, vec_id, label, vector, and perhaps windows) as blocks: block, dims, labels, payload.

    A block holds vectors of one length, at most ``most``, in order of vec_id (null last). Rows are dealt by
    length, label and hash, so that blocks meet few labels and a common label fills many of them.
    """
    parts = max(1, -(-total // most), min(16, total // 64))
    dealt = rows.repartitionByRange(parts, F.size("vector"), "label", F.xxhash64("node"), "node")
    windows = "windows" in rows.columns

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.RecordBatch]] = {}
        counts: dict[int, int] = {}
        number = TaskContext.get().partitionId() << 24

        def emit(dims: int) -> pa.RecordBatch:
            nonlocal number
            t = pa.Table.from_batches(held.pop(dims)).combine_chunks()
            counts.pop(dims)
            t = t.take(pa.compute.sort_indices(t, sort_keys=[("vec_id", "ascending"), ("node", "ascending")]))
            labels = np.array(t["label"].to_pylist(), str)
            arrays = {"node": t["node"].to_numpy(), "label": labels, "vector": _whole(pa.compute.list_flatten(t["vector"]).to_numpy().reshape(len(t), dims))}
            if windows:
                offsets = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(t["windows"]).to_numpy())])
                arrays |= {"offsets": offsets, "positive": pa.compute.list_flatten(t["windows"]).to_numpy()}
            row = {"block": [number], "dims": [dims], "labels": [sorted(set(labels.tolist()))], "payload": [_saved(**arrays)]}
            number += 1
            return pa.RecordBatch.from_pydict(row, pa.schema([("block", pa.int64()), ("dims", pa.int32()), ("labels", pa.list_(pa.string())), ("payload", pa.binary())]))

        for batch in batches:
            sizes = pa.compute.list_value_length(batch.column("vector")).to_numpy()
            for dims in np.unique(sizes).tolist():
                same = batch.filter(pa.array(sizes == dims))
                while same.num_rows:
                    room = most - counts.get(dims, 0)
                    held.setdefault(dims, []).append(same.slice(0, room))
                    counts[dims] = counts.get(dims, 0) + min(room, same.num_rows)
                    same = same.slice(room)
                    if counts[dims] == most:
                        yield emit(dims)
        for dims in list(held):
            yield emit(dims)

    return dealt.mapInArrow(pack, "block long, dims int, labels array<string>, payload binary")


def _tiles(anchors: DataFrame, candidates: DataFrame, pairs: DataFrame, groups: int, scorer, schema: str) -> DataFrame:
    """``scorer`` of each candidate block with the anchor blocks that ``pairs`` (a, c) give it, some TOGETHER at a time."""
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("a"), F.lit(groups)))
    given = salted.select("c", "salt").distinct().join(candidates.select(F.col("block").alias("c"), "payload"), "c").select("c", "salt", "payload")
    asked = salted.join(anchors.select(F.col("block").alias("a"), F.col("payload").alias("asked")), "a").select(F.col("c").alias("to"), F.col("salt").alias("to_salt"), "asked")
    return given.groupBy("c", "salt").cogroup(asked.groupBy("to", "to_salt")).applyInArrow(scorer, schema)


def _sliced(given: pa.Table, asked: pa.Table):
    """Candidates, a slice of anchors, their scores, and where the labels are equal; for every slice of the anchor blocks."""
    if not (given.num_rows and asked.num_rows):
        return
    c = _opened(given["payload"][0].as_py())
    for payload in asked["asked"]:
        a = _opened(payload.as_py())
        for at in range(0, len(a["node"]), SLICE):
            cut = slice(at, at + SLICE)
            yield c, a, cut, scores(a["vector"][cut], c["vector"]), a["label"][cut][:, None] == c["label"][None, :]


_FOUND = pa.schema([("anchor", pa.int64()), ("positive", pa.int64()), ("node", pa.int64()), ("score", pa.int64())])


def _nearest_scorer(k: int):
    def run(given: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        for c, a, cut, score, same in _sliced(given, asked):
            row, column = best(score, same, k)
            out.append(pa.table([a["node"][cut][row], np.zeros(len(row), np.int64), c["node"][column], score[row, column]], schema=_FOUND))
        return pa.concat_tables(out) if out else _FOUND.empty_table()

    return run


def _window_scorer(k: int, least: int, most: int):
    def run(given: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        for c, a, cut, score, same in _sliced(given, asked):
            offsets = a["offsets"]
            ends = range(cut.start, min(cut.stop, len(a["node"])))
            for j in range(max(int(offsets[i + 1] - offsets[i]) for i in ends)):
                # the j-th window of each anchor of the slice; one that has none gets an empty window
                has = [offsets[i] + j < offsets[i + 1] for i in ends]
                p = [int(a["positive"][offsets[i] + j]) if h else 0 for i, h in zip(ends, has, strict=True)]
                low = np.array([min(max(-(-least * x // 100), _LEAST), _MOST) for x in p], np.int64)
                high = np.array([min(max(most * x // 100, _LEAST), _MOST) for x in p], np.int64)
                inside = ~same & (score >= low[:, None]) & (score <= high[:, None]) & np.array(has)[:, None]
                row, column = best(score, inside, k)
                out.append(pa.table([a["node"][cut][row], np.array(p, np.int64)[row], c["node"][column], score[row, column]], schema=_FOUND))
        return pa.concat_tables(out) if out else _FOUND.empty_table()

    return run


def _first(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first ``k`` of each group, in order of score (highest first) and vec_id (null last), each row as often as it is repeated."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "node")
    # rows of no copies are gone, so no more than k distinct rows can count
    few = found.where("copies > 0").withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    before = F.coalesce(F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    each = few.withColumn("before", before).where(F.col("before") < k)
    each = each.withColumn("rank", F.explode(F.sequence(F.col("before") + 1, F.least(F.col("before") + F.col("copies"), F.lit(k).cast("long")))))
    return each.select(*by, "node", "vec_id", "score", F.col("rank").cast("int").alias("rank"))


def hard_negatives(
    spark: SparkSession, vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95
) -> DataFrame:
    """Per anchor and positive, the first ``negatives`` rows of another label with scores from ``least`` to ``most`` per cent of the positive's.

    ``vectors`` has vec_id, label and vector (an array of doubles that hold
    whole numbers); ``anchor`` is true for the rows that ask; all rows answer.
    Returns anchor_id, positive_id, rank, negative_id, positive_score and
    negative_score. A score is the inner product, exact; scores beyond a long
    count as the nearest long. Higher scores come first, ties by smaller vec_id,
    null last. An anchor's positives are its first ``positives`` other rows of
    equal label. Rows without label or vector, or with a null or non-finite
    component, take no part; vectors of unequal length don't meet. Rows that
    repeat are rows of their own: a repeated anchor asks, and counts as another
    row, as often as it is there. Other columns are ignored. An empty table
    gives an empty result.
    """
    root = shared_dir(spark, "negatives")
    known = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    rows = vectors.select("vec_id", F.col("label").cast("string").alias("label"), F.col("vector"), anchor.alias("asks"))
    rows = rows.where(F.coalesce(known & F.col("label").isNotNull(), F.lit(False)))
    rows = rows.groupBy("vec_id", "label", "vector").agg(F.count(F.lit(1)).alias("copies"), F.bool_or(F.coalesce("asks", F.lit(False))).alias("asks"))
    rows = materialize(rows.withColumn("node", F.monotonically_increasing_id()), f"{root}/rows")
    total, asking = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    about = rows.select("node", "vec_id", "copies")
    fields = ["node", "vec_id", "label", "vector"]
    c = materialize(_blocks(rows.select(*fields), CANDIDATES, total), f"{root}/candidates")
    a = materialize(_blocks(rows.where("asks").select(*fields), ANCHORS, asking), f"{root}/anchors")
    groups = -(-asking // (ANCHORS * TOGETHER)) or 1
    schema = "anchor long, positive long, node long, score long"

    met = lambda blocks, name: blocks.select(F.col("block").alias(name), "dims", F.size("labels").alias(f"labels_{name}"), F.explode("labels").alias("label"))
    shared = materialize(met(a, "a").join(met(c, "c"), ["dims", "label"]).select("a", "c", "labels_a", "labels_c").distinct(), f"{root}/shared")
    # one more than asked for, since an anchor meets itself
    near = _tiles(a, c, shared.select("a", "c"), groups, _nearest_scorer(positives + 1), schema).drop("positive").join(about, "node")
    near = near.withColumn("copies", F.col("copies") - (F.col("node") == F.col("anchor")).cast("long"))
    near = materialize(_first(near, ["anchor"], positives).withColumnRenamed("vec_id", "positive_id"), f"{root}/positives")

    windows = near.groupBy(F.col("anchor").alias("node")).agg(F.array_sort(F.collect_set("score")).alias("windows"))
    a = materialize(_blocks(rows.where("asks").select(*fields).join(windows, "node"), ANCHORS, asking), f"{root}/windows")
    single = lambda name: F.when(F.size("labels") == 1, F.col("labels")[0]).alias(f"only_{name}")
    numbered = c.select(F.col("block").alias("c"), F.col("dims").alias("dims_c"), single("c"))
    every = a.select(F.col("block").alias("a"), "dims", single("a")).join(numbered, (F.col("dims") == F.col("dims_c")))
    every = every.where(F.coalesce(F.col("only_a") != F.col("only_c"), F.lit(True))).select("a", "c")
    far = _tiles(a, c, every, groups, _window_scorer(negatives, least, most), schema).join(about, "node")
    far = _first(far, ["anchor", "positive"], negatives)
    far = far.select("anchor", F.col("positive").alias("score"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    asked = about.select(F.col("node").alias("anchor"), F.col("vec_id").alias("anchor_id"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("asking"))
    out = near.select("anchor", "positive_id", "score").join(far, ["anchor", "score"]).join(asked, "anchor")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", F.col("score").alias("positive_score"), "negative_score")

"""Near-duplicate documents by b-bit MinHash.

Texts are sets of word shingles. Each distinct set gets K minima; bands of
whole minima give the candidates, the low bits of the minima, packed into
longs, give a collision-corrected estimate by counting bits, and candidates
whose estimate isn't far below the threshold are confirmed on the full sets.

Groups of copies never expand into all pairs. Equal sets are one node from the
start. Inside a bucket of candidates, members are first compared with one hub
(the member that shares most buckets). What the links found this way join is
one component; only members outside their bucket's largest component are
compared with the others, and only where bounds on the overlap (shingles that
no other such document has can't be shared, nor those whose bit is missing in
the other's bitmap) leave a link possible. So every
candidate pair is joined, excluded by a bound, or compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafray.llm import words
from leafray.llm.common import components, join_counted, materialize, shared_dir, sieved, without

WORDS = 5
THRESHOLD = 75
K, BAND_ROWS, BITS = 128, 4, 4
N_BANDS = K // BAND_ROWS
#: Longs of a set's bitmap, whose bits bound the overlap of two sets from above.
BITMAP = 32
#: A candidate is dropped if its estimate lies this far (in hundredths) below the threshold: seven standard errors.
SLACK = 30

_rng = np.random.default_rng(20240229)
_A = (_rng.integers(0, 2**31, K, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_C = np.uint32(0x85EBCA6B)
_BAND = _rng.integers(0, 2**63, (N_BANDS, BAND_ROWS), dtype=np.uint64) | np.uint64(1)


def minima(shingles: np.ndarray) -> np.ndarray:
    """K minima of 32-bit hashes over a non-empty set."""
    h = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(K, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(h), 512):
        x = h[i : i + 512, None] * _A
        x ^= x >> np.uint32(16)
        x *= _C
        np.minimum(out, x.min(axis=0), out=out)
    return out


def packed(m: np.ndarray) -> np.ndarray:
    """The low BITS bits of each minimum, packed into K * BITS / 64 longs per row."""
    low = (m & np.uint32(15)).astype(np.uint8)
    return np.ascontiguousarray(low[:, 0::2] | (low[:, 1::2] << 4)).view(np.int64)


def band_keys(m: np.ndarray) -> np.ndarray:
    parts = m.reshape(len(m), -1, BAND_ROWS).astype(np.uint64) + np.uint64(1)
    return words.mixed((parts * _BAND).sum(axis=2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def estimate(a: Column, b: Column) -> Column:
    """Similarity in hundredths from packed signatures: (matches - C) / (1 - C), where C = 2 ** -BITS is chance."""

    def differing(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        folded = z.bitwiseOR(F.shiftrightunsigned(z, 1)).bitwiseOR(F.shiftrightunsigned(z, 2)).bitwiseOR(F.shiftrightunsigned(z, 3))
        return F.bit_count(folded.bitwiseAND(F.lit(0x1111111111111111)))

    lost = F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda s, x: s + x)
    chance = 2.0**-BITS
    return 100.0 * ((1.0 - lost / float(K)) - chance) / (1.0 - chance)


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """A bit for each shingle by its hash, as BITMAP longs."""
    bits = np.zeros(64 * BITMAP, np.uint8)
    bits[(shingles % np.uint64(64 * BITMAP)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


def overlap_bound(a: Column, b: Column, size: Column) -> Column:
    """No more of a set's ``size`` shingles can be shared than those whose bits the other set's bitmap has too."""
    lost = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y))))
    return size - F.aggregate(lost, F.lit(0), lambda s, x: s + x)


def sign(docs: DataFrame, length: int = WORDS) -> DataFrame:
    """doc_id, row, print (of the text), n_shingles, text_sha, and for non-empty sets digest, bits and bands."""
    ints = pa.list_(pa.int64())
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("print", pa.int64()), ("n_shingles", pa.int64()), ("text_sha", pa.binary()), ("digest", pa.binary()), ("bits", ints), ("bands", ints)])

    def nested(matrix: np.ndarray, full: np.ndarray) -> pa.Array:
        width = matrix.shape[1]
        offsets = np.concatenate([[0], np.cumsum(full * width)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.reshape(-1)), mask=pa.array(~full))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in words.pieces(batches, "text"):
            sets = words.shingle_sets(words.Words(piece.column("text"), words.LOWER), length)
            full = np.array([len(s) > 0 for s in sets], bool)
            m = np.array([minima(s) for s in sets if len(s)], np.uint32).reshape(-1, K)
            shas = [hashlib.sha256(t.as_buffer() if t.is_valid else b"").digest() for t in piece.column("text").cast(pa.large_binary())]
            digests = [xxhash.xxh3_128_digest(s) if len(s) else None for s in sets]
            sizes = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([*[piece.column(c) for c in ("doc_id", "row", "print")], sizes, pa.array(shas, pa.binary()), pa.array(digests, pa.binary()), nested(packed(m), full), nested(band_keys(m), full)], schema=schema)

    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), F.xxhash64("text").alias("print"), "text")
    return rows.mapInArrow(run, "doc_id long, row long, print long, n_shingles long, text_sha binary, digest binary, bits array<long>, bands array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, length: int, repeats: bool) -> DataFrame:
    """The full sets of the ``wanted`` nodes (node, id, print, digest, bits, n): node, n, bits, bitmap, shingles.

    Texts are met by id and print, so that rows without an id don't all meet
    each other; with ``repeats``, rows that repeat both are one text first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in words.pieces(batches, "text"):
            sets = words.shingle_sets(words.Words(piece.column("text"), words.LOWER), length)
            same = pa.array([xxhash.xxh3_128_digest(s) == d for s, d in zip(sets, piece.column("digest").to_pylist(), strict=True)], pa.bool_())
            lists = [words.listed(x, pa.int64()) for x in ([bitmap(s) for s in sets], [s.view(np.int64) for s in sets])]
            yield pa.RecordBatch.from_arrays([*[piece.column(c) for c in ("node", "n", "bits")], *lists], names=["node", "n", "bits", "bitmap", "shingles"]).filter(same)

    texts = docs.select(F.col("doc_id").alias("id2"), F.xxhash64("text").alias("print2"), "text")
    texts = sieved(texts, [F.col("id2"), F.col("print2")], wanted, [F.col("id"), F.col("print")]).where("maybe_")
    texts = texts.distinct() if repeats else texts
    joined = texts.join(wanted, (F.col("print") == F.col("print2")) & F.col("id").eqNullSafe(F.col("id2"))).select("node", "digest", "n", "bits", "text")
    return joined.mapInArrow(run, "node long, n long, bits array<long>, bitmap array<long>, shingles array<long>")


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Of candidate pairs (a, b), those whose full sets reach the threshold."""
    light = sets.select("node", "n", "bits")
    a = light.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("bits").alias("bits_a"))
    b = light.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bits_b"))
    near = pairs.join(a, "a").join(b, "b")
    near = near.where((estimate(F.col("bits_a"), F.col("bits_b")) >= threshold - SLACK) & (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * threshold))
    sa, sb = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = near.select("a", "b", "na", "nb").join(sa, "a").join(sb, "b").withColumn("common", F.size(F.array_intersect("sa", "sb")))
    return both.where(F.col("common") * 100 >= threshold * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b")


def _cross_pairs(members: DataFrame, sets: DataFrame, mapping: DataFrame, threshold: int, root: str) -> DataFrame:
    """Candidate pairs of different components that the overlap bound doesn't exclude."""
    known = members.join(mapping, "node", "left").withColumn("component", F.coalesce("component", "node"))
    sizes = known.groupBy("key", "component").agg(F.count(F.lit(1)).alias("c"))
    major = sizes.groupBy("key").agg(F.max(F.struct("c", "component"))["component"].alias("major"), F.count(F.lit(1)).alias("parts")).where("parts > 1").select("key", "major")
    known = materialize(known.join(major, "key"), f"{root}/split")
    nodes = known.select("node").distinct()
    tokens = sets.join(nodes, "node", "left_semi").select("node", F.explode("shingles").alias("token"))
    own = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("c"), F.min("node").alias("node")).where("c = 1").groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    shared = nodes.join(own, "node", "left").select("node", F.coalesce("own", F.lit(0)).alias("own"))
    known = materialize(known.join(shared, "node").withColumn("most", F.col("n") - F.col("own")), f"{root}/bounded")
    # the overlap of a link is at least t / (1 + t) of both sizes together
    able = known.where((100 + threshold) * F.col("most") >= threshold * (F.col("n") + F.ceil(F.col("n") * threshold / 100)))
    able = able.join(sets.select("node", "bitmap"), "node")
    left = able.where("component <> major").select("key", *[F.col(c).alias(f"{c}_l") for c in ("node", "n", "most", "component", "bitmap")])
    right = able.select("key", "node", "n", "most", "component", "bitmap", (F.col("component") == F.col("major")).alias("of_major"))
    enough = lambda overlap: (100 + threshold) * overlap >= threshold * (F.col("n") + F.col("n_l"))
    possible = (
        (F.col("component") != F.col("component_l"))
        & (F.col("of_major") | (F.col("node_l") < F.col("node")))
        & enough(F.least("most", "most_l"))
        & enough(overlap_bound(F.col("bitmap"), F.col("bitmap_l"), F.col("n")))
        & enough(overlap_bound(F.col("bitmap_l"), F.col("bitmap"), F.col("n_l")))
    )
    return left.join(right, "key").where(possible).select(F.least("node", "node_l").alias("a"), F.greatest("node", "node_l").alias("b")).distinct()


def near_copies(spark: SparkSession, docs: DataFrame, length: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, row, print, n_shingles, text_sha, component, component_id, kept.

    ``docs`` needs doc_id and text; other columns are ignored. Texts without
    words (null, empty, white space) have empty sets and link with nothing.
    component_id is the smallest doc_id of the component; a null doc_id counts
    as larger than all others. kept means doc_id = component_id, so rows that
    repeat a doc_id share their fate. An empty table gives an empty result.
    """
    root = shared_dir(spark, "minhash")
    signed = materialize(sign(docs, length), f"{root}/signed")
    total = signed.count()
    full = signed.where("n_shingles > 0")
    classes = materialize(full.groupBy("digest").agg(F.min("row").alias("node"), F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies")), f"{root}/classes")
    nodes = full.join(classes.select(F.col("node").alias("row")), "row", "left_semi")

    keys = nodes.select(F.col("row").alias("node"), F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    shared = materialize(keys.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), f"{root}/shared_keys")
    members = materialize(join_counted(keys, shared, "key", "c", N_BANDS * total, 100 * N_BANDS), f"{root}/members")
    weight = members.groupBy("node").agg(F.sum("c").alias("weight"))
    candidates = nodes.join(weight, nodes["row"] == weight["node"]).select("node", F.col("doc_id").alias("id"), "print", "digest", "bits", F.col("n_shingles").alias("n"))
    repeats = not signed.groupBy("doc_id", "print").count().where("count > 1").isEmpty()
    sets = materialize(_sets(docs, candidates, length, repeats), f"{root}/sets")

    hubs = members.join(weight, "node").groupBy("key").agg(F.max(F.struct("weight", "node"))["node"].alias("hub"), F.count(F.lit(1)).alias("c"))
    hubs = materialize(hubs, f"{root}/hubs")
    stars = join_counted(members.select("key", "node"), hubs, "key", "c", N_BANDS * total, 100 * N_BANDS).where("node <> hub")
    stars = stars.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    links = materialize(_confirmed(stars, sets, threshold), f"{root}/star_links")
    mapping = components(links, f"{root}/first")
    cross = materialize(_confirmed(_cross_pairs(members, sets, mapping, threshold, root), sets, threshold), f"{root}/cross_links")
    if not cross.isEmpty():
        mapping = components(links.union(cross), f"{root}/second")

    label = classes.join(mapping, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = label.groupBy("component").agg(F.min("first_id").alias("component_id"))
    label = materialize(label.join(smallest, "component").select("digest", "copies", "component", "component_id"), f"{root}/labels")
    of_full = join_counted(full.select("doc_id", "row", "print", "n_shingles", "text_sha", "digest"), label, "digest", "copies", total)
    out = of_full.select("doc_id", "row", "print", "n_shingles", "text_sha", "component", "component_id")
    alone = signed.where("n_shingles = 0").select("doc_id", "row", "print", "n_shingles", "text_sha", F.col("row").alias("component"), F.col("doc_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, length: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each component, all columns as they are; texts without words all stay.

    The row that stays has the smallest doc_id (null is larger than all others)
    and of these the smallest SHA-256 of the text. Rows are told apart by
    doc_id and text; of rows that repeat both, one stays.
    """
    key = ["doc_id", "text_sha"]
    full = near_copies(spark, docs, length, threshold).where("n_shingles > 0")
    root = shared_dir(spark, "near")
    texts = materialize(full.groupBy("component", "print", *key).agg(F.count(F.lit(1)).alias("times")), f"{root}/texts")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), *key))
    groups = materialize(texts.groupBy("component").agg(best.alias("keep"), F.count(F.lit(1)).alias("n"), F.sum("times").alias("rows")).where("rows > 1").drop("rows"), f"{root}/groups")
    stays = F.col("doc_id").eqNullSafe(F.col("keep.doc_id")) & (F.col("text_sha") == F.col("keep.text_sha"))
    fate = join_counted(texts, groups, "component", "n", texts.count()).withColumn("stays", stays).where("not stays or times > 1")
    fate = materialize(fate.select(F.col("doc_id").alias("doc_id_"), F.col("print").alias("print_"), "stays"), f"{root}/fate")
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    own = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]).withColumn("print", F.xxhash64(F.col(names["text"])))
    out = without(own, [F.col(names["doc_id"]), F.col("print")], fate, ["doc_id_", "print_"])
    again = fate.where("stays")
    if not again.isEmpty():
        same = F.col(names["doc_id"]).eqNullSafe(F.col("doc_id_")) & (F.col("print") == F.col("print_"))
        out = out.unionByName(own.join(again, same, "left_semi").dropDuplicates([names["doc_id"], "print"]))
    return out.select(*[F.col(n).alias(c) for c, n in names.items()])

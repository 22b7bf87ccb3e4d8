"""Pieces shared by the corpus operators: shared storage, joins on hot keys, components."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Runs of these ASCII characters separate words; everything else belongs to a word.
SPACE = r"[\x20\x09-\x0D]+"
#: Most keys that a count table may mark as hot, and so the most rows a hot-key broadcast has.
HOT_KEYS = 1000
#: Bitmaps of a sieve, of 4 kB each, and so the most that it broadcasts.
SIEVE = 1024


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share.

    Where that setting is absent, a local run (tests) sets a temporary folder of
    this machine as its checkpoint folder; on a cluster that is an error.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="leafray-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/leafray-{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def scratch_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have yet."""
    name = stem
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def join_counted(rows: DataFrame, keyed: DataFrame, key: str, count: str, total: int, hot_keys: int = HOT_KEYS) -> DataFrame:
    """Inner join of ``rows`` to ``keyed`` (one row per key, with the key's number of rows in ``rows``).

    A key that holds more than 1/hot_keys of all ``total`` rows is hot. There can
    be at most hot_keys such keys, so their side is broadcast whatever the input
    size; every other key shuffles with a bounded share of the rows.
    """
    limit = max(1, total // hot_keys)
    hot = F.broadcast(keyed.where(F.col(count) > limit))
    cold = rows.join(F.broadcast(keyed.where(F.col(count) > limit).select(key)), key, "left_anti")
    return rows.join(hot, key).unionByName(cold.join(keyed.where(F.col(count) <= limit), key))


def sieved(rows: DataFrame, key: list[Column], keys: DataFrame, key_of: list[Column], name: str = "maybe_") -> DataFrame:
    """``rows`` with a boolean ``name``: false only where no row of ``keys`` has the same key, so that those need not meet ``keys``.

    The keys' hashes set bits of SIEVE bitmaps, which are broadcast: 4 MB at
    most, whatever the input. With very many keys ever more rows pass, and what
    passes is still joined exactly, so only the amount that moves depends on it.
    """
    slot = lambda h: F.pmod(F.shiftrightunsigned(h, 15), F.lit(SIEVE))
    bit = lambda h: h.bitwiseAND(F.lit(32767))
    # as strings, since an int and a long of one value have different hashes
    hash_ = lambda columns: F.xxhash64(*[c.cast("string") for c in columns])
    hashed = keys.select(hash_(key_of).alias("h_"))
    bits = hashed.select(slot(F.col("h_")).alias("slot_"), bit(F.col("h_")).alias("bit_")).groupBy("slot_").agg(F.bitmap_construct_agg("bit_").alias("bits_"))
    own = rows.withColumn("h_", hash_(key))
    met = own.join(F.broadcast(bits), slot(F.col("h_")) == F.col("slot_"), "left")
    at = bit(F.col("h_"))
    byte = F.conv(F.hex(F.substring(F.col("bits_"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    return met.withColumn(name, F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))).drop("h_", "slot_", "bits_")


def without(rows: DataFrame, key: list[Column], gone: DataFrame, gone_key: list[str]) -> DataFrame:
    """``rows`` whose null-safe ``key`` is not in ``gone``; only rows that a sieve lets pass are shuffled."""
    named = gone.select(*[F.col(c).alias(f"{c}_gone") for c in gone_key])
    marked = sieved(rows, key, gone, [F.col(c) for c in gone_key])
    same = reduce(lambda a, b: a & b, [k.eqNullSafe(F.col(f"{c}_gone")) for k, c in zip(key, gone_key, strict=True)])
    doubtful = marked.where("maybe_").join(named, same, "left_anti")
    return marked.where("not maybe_").unionByName(doubtful).drop("maybe_")


def components(edges: DataFrame, root: str) -> DataFrame:
    """Connected components of ``edges(a, b)``: one row ``(node, component)`` per node of an edge.

    Each round hooks every node on its smallest neighbour, follows the pointers
    twice, and contracts the edges to pointers; edges shrink geometrically, so
    a few rounds suffice for stars and O(log n) for chains. Only counts reach
    the driver, and each round's tables are written to ``root``.
    """
    edges = materialize(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), f"{root}/edges0"
    )
    mapping = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().select("node", F.col("node").alias("component"))
    mapping = materialize(mapping, f"{root}/map0")
    step = 0
    while not edges.isEmpty():
        step += 1
        both = edges.union(edges.select("b", "a"))
        hook = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        hook = materialize(hook.select("node", F.least("node", "m").alias("p")), f"{root}/hook{step}")
        for jump in range(2):
            up = hook.select(F.col("node").alias("p"), F.col("p").alias("pp"))
            hook = materialize(hook.join(up, "p").select("node", F.col("pp").alias("p")), f"{root}/hook{step}_{jump}")
        mapping = materialize(
            mapping.join(hook.select(F.col("node").alias("component"), "p"), "component", "left").select(
                "node", F.coalesce("p", "component").alias("component")
            ),
            f"{root}/map{step}",
        )
        a, b = hook.select(F.col("node").alias("a"), F.col("p").alias("pa")), hook.select(F.col("node").alias("b"), F.col("p").alias("pb"))
        edges = materialize(
            edges.join(a, "a").join(b, "b").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).where("a < b").distinct(),
            f"{root}/edges{step}",
        )
    return mapping


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file; the folder can be moved with LEAFRAY_TOKENIZERS."""
    folder = os.environ.get("LEAFRAY_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))

"""Exact dedup by a stateful stream.

Every row's normalised text is reduced to a digest. A Structured Streaming
aggregation, with its keyed state in RocksDB and no expiry, retains for each
digest the stable identifier of the row that stays, a locator of its content
and the number of rows seen. Rows whose digest was met before are hits: their
full text is compared with the text at the retained locator, and rows that
differ in spite of the digest form groups of their own.

Only DataFrame operations run on the executors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafray.llm.common import HOT_KEYS, SPACE, join_counted, materialize, shared_dir, sieved, text_or_empty, without

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # many small stores would otherwise each reserve megabytes of disk ahead
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "48",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def normalised(text: str | Column) -> Column:
    """The text with each run of ASCII white space as one space; null counts as empty."""
    return F.regexp_replace(text_or_empty(text), SPACE, " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def entries(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """What the stream consumes: digest and entry (identifier, nulls last, then locator) per row, and a print of the text as it is."""
    return docs.select(
        digest(normalised("text")).alias("digest"),
        F.struct(
            F.col("doc_id").isNull().alias("no_id"),
            F.col("doc_id").alias("doc_id"),
            F.monotonically_increasing_id().alias("row"),
            F.input_file_name().alias("file"),
        ).alias("entry"),
        F.xxhash64("text").alias("print"),
    )


def stream_state(spark: SparkSession, source: str, schema, root: str, files_per_batch: int | None = None) -> DataFrame:
    """Run the stream over the entry files in ``source``; one row per digest: digest, keep (entry), n.

    The state never expires. A batch writes the digests it changed; a repeat of
    a batch after a failure overwrites its own folder, so results are exact.
    """
    before = {k: spark.conf.get(k, None) for k in STREAM_CONF}
    try:
        for k, v in STREAM_CONF.items():
            spark.conf.set(k, v)
        reader = spark.readStream.schema(schema)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        state = reader.parquet(source).groupBy("digest").agg(F.min("entry").alias("keep"), F.count(F.lit(1)).alias("n"))
        empty = spark.createDataFrame([], state.schema)
        empty.write.parquet(f"{root}/state/batch=-1")
        query = (
            state.writeStream.outputMode("update")
            .option("checkpointLocation", f"{root}/stream")
            .trigger(availableNow=True)
            .foreachBatch(lambda changed, batch: changed.write.mode("overwrite").parquet(f"{root}/state/batch={batch}"))
            .start()
        )
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    updates = spark.read.schema(empty.schema).parquet(f"{root}/state")
    return updates.groupBy("digest").agg(F.min("keep").alias("keep"), F.max("n").alias("n"))


def _byte_check(docs: DataFrame, found: DataFrame, total: int, digest) -> DataFrame:
    """Digests whose hits don't all have the same full text.

    The texts of these rows move once, by doc_id and print (rows without an id would all meet each
    other by id alone), to be normalised again and gathered by digest. The smallest and the
    largest text of a group are equal if and only if all are; a hot group is
    dealt over salts first.
    """
    share = max(1, total // HOT_KEYS)
    hits = found.where("n > 1").select(F.col("doc_id").alias("hit_id"), "print", F.col("digest").alias("hit"), F.ceil(F.col("n") / share).alias("salts")).distinct()
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("own_print"))
    texts = sieved(texts, [F.col("doc_id"), F.col("own_print")], hits, [F.col("hit_id"), F.col("print")]).where("maybe_")
    texts = texts.join(hits, (F.col("own_print") == F.col("print")) & F.col("doc_id").eqNullSafe(F.col("hit_id")))
    texts = texts.select(normalised("text").alias("norm"), "hit", F.pmod(F.xxhash64("doc_id", "own_print"), "salts").alias("salt"))
    own = texts.where(digest(F.col("norm")) == F.col("hit"))
    parts = own.groupBy("hit", "salt").agg(F.min("norm").alias("lo"), F.max("norm").alias("hi"))
    whole = parts.groupBy("hit").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return whole.where("lo <> hi").select(F.col("hit").alias("digest"))


def copies(spark: SparkSession, docs: DataFrame, digest: Callable[[Column], Column] = sha256, files_per_batch: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, digest, print, row, norm.

    ``docs`` needs doc_id and text; other columns are ignored. Null text counts
    as empty, and all empty texts form one group. Rows with a null doc_id come
    last in the choice of the row that stays. Rows that repeat both doc_id and
    text are copies of each other: exactly one of them is kept. ``print`` is a
    hash of the text as it is. An empty table gives an empty result.
    """
    root = shared_dir(spark, "exact")
    rows = materialize(entries(docs, digest), f"{root}/rows")
    state = materialize(stream_state(spark, f"{root}/rows", rows.schema, root, files_per_batch), f"{root}/kept")
    total = rows.count()
    flat = rows.select("digest", "print", F.col("entry.doc_id").alias("doc_id"), F.col("entry.row").alias("row"))
    kept = state.select("digest", "n", F.col("keep.doc_id").alias("keep_id"), F.col("keep.row").alias("keep_row"))
    found = materialize(join_counted(flat, kept, "digest", "n", total), f"{root}/found")
    broken = materialize(_byte_check(docs, found, total, digest), f"{root}/broken")
    if not broken.isEmpty():
        return _regrouped(docs, flat, state, broken, digest, total)
    return found.select(
        "doc_id", "keep_id", F.col("n").alias("group_size"), (F.col("row") == F.col("keep_row")).alias("kept"), "digest", "print", "row", F.lit(None).cast("string").alias("norm")
    )


def _regrouped(docs, flat, state, broken, digest, total) -> DataFrame:
    """Groups by full text for the digests that hold different texts (a broken or colliding digest)."""
    texts = docs.select("doc_id", F.xxhash64("text").alias("print"), normalised("text").alias("norm")).withColumn("digest", digest(F.col("norm"))).join(broken, "digest")
    texts = texts.withColumn("row", F.monotonically_increasing_id())
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("row"))
    groups = texts.groupBy("digest", "norm").agg(F.min(key).alias("keep"), F.count(F.lit(1)).alias("n"))
    split = texts.join(groups, ["digest", "norm"]).select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("keep.row")).alias("kept"),
        "digest",
        "print",
        "row",
        "norm",
    )
    whole = state.join(broken, "digest", "left_anti").select("digest", "n", F.col("keep.doc_id").alias("keep_id"), F.col("keep.row").alias("keep_row"))
    rest = join_counted(flat, whole, "digest", "n", total).select(
        "doc_id", "keep_id", F.col("n").alias("group_size"), (F.col("row") == F.col("keep_row")).alias("kept"), "digest", "print", "row", F.lit(None).cast("string").alias("norm")
    )
    return rest.unionByName(split)


def drop_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that copy another row's text; all columns stay as they are.

    Of rows that repeat both doc_id and text, one stays.
    """
    key = ["doc_id", "print"]
    marked = copies(spark, docs).groupBy(*key).agg(F.count_if("kept").alias("stay"), F.count(F.lit(1)).alias("rows"))
    fate = materialize(marked.where("stay < rows").select(*[F.col(c).alias(f"{c}_") for c in key], (F.col("stay") > 0).alias("stays")), shared_dir(spark, "fate"))
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    own = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]).withColumn("print", F.xxhash64(F.col(names["text"])))
    of_row = [F.col(names["doc_id"]), F.col("print")]
    out = without(own, of_row, fate, ["doc_id_", "print_"])
    again = fate.where("stays")
    if not again.isEmpty():
        same = F.col(names["doc_id"]).eqNullSafe(F.col("doc_id_")) & (F.col("print") == F.col("print_"))
        out = out.unionByName(own.join(again, same, "left_semi").dropDuplicates([names["doc_id"], "print"]))
    return out.select(*[F.col(n).alias(c) for c, n in names.items()])

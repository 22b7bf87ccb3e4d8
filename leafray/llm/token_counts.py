"""Token counts with overlap resynchronisation for huge documents.

Documents up to a limit are encoded whole. Longer ones are cut into overlapping
chunks, which are dealt over the cluster and encoded with offsets. Neighbouring
chunks are spliced at a stable common boundary: a place inside their overlap
where both have a pre-token boundary.

Why such a place is safe: the pre-tokenizer's pattern has no look-behind, so from
a true boundary on, all further matches are those of the whole text. The left
chunk's boundaries are true (by induction from the text's start) up to a margin
before its end that covers look-ahead and the longest special token; a boundary
that the right chunk shares with it therefore carries the truth over. Chunks
that share none are encoded again with overlaps four times as wide, until the
overlap reaches over the whole document.
"""

from __future__ import annotations

import os
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafray.llm import words
from leafray.llm.common import materialize, shared_dir

#: Characters of a chunk's own part; longer documents are cut.
CHUNK = 16_384
#: Characters that a chunk reaches into the next one at first.
OVERLAP = 256
#: Characters before a chunk's end in which its boundaries are not trusted.
MARGIN = 32


@lru_cache(maxsize=4)
def library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    if t.pre_tokenizer is None or "ByteLevel" not in str(t.pre_tokenizer):
        raise ValueError(f"{path}: splicing is proven for byte-level pre-tokenizers only")
    if max((len(a.content) for a in t.get_added_tokens_decoder().values()), default=0) + 2 > MARGIN:
        raise ValueError(f"{path}: special tokens longer than the margin")
    return t


def chunks(text: str, chunk: int, overlap: int) -> list[tuple[int, str]]:
    """(start, chunk text) for each chunk; each reaches ``overlap`` characters beyond the next one's start."""
    starts = range(0, max(1, len(text)), chunk)
    out = []
    for s in starts:
        out.append((s, text[s : s + chunk + overlap]))
        if s + chunk + overlap >= len(text):
            break
    return out


def boundaries(encoding, after: int, upto: int) -> tuple[list[int], list[int]]:
    """Pre-token starts beyond the character ``after``, ``upto`` included, and the number of tokens before each."""
    n = len(encoding)
    start = lambda k: encoding.token_to_chars(k)[0]
    first = bisect_right(range(n), after, key=start)
    at, before = [], []
    word = encoding.token_to_word(first - 1) if first else None
    for k in range(first, n):
        if (place := start(k)) > upto:
            break
        last, word = word, encoding.token_to_word(k)
        if word != last:
            at.append(place)
            before.append(k)
    return at, before


def _whole(docs: DataFrame, path: str, chunk: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = library(path)
        for batch in words.pieces(batches, "text"):
            texts = batch.column(1).to_pylist()
            n = []
            for i in range(0, len(texts), 256):
                n += [len(e.ids) for e in t.encode_batch_fast(texts[i : i + 256], add_special_tokens=False)]
            n_bytes = [len(x.encode()) for x in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    short = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(F.length("text") <= chunk)
    return short.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")


def _cut(huge: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """One row per chunk: row, doc_id, n_bytes, n_chars, start, part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_chars", pa.int64()), ("start", pa.int64()), ("part", pa.string())])
        for batch in batches:
            for row, doc_id, text in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                n_bytes = len(text.encode())
                cut = chunks(text, chunk, overlap)
                yield pa.RecordBatch.from_pylist([{"row": row, "doc_id": doc_id, "n_bytes": n_bytes, "n_chars": len(text), "start": s, "part": p} for s, p in cut], schema)

    return huge.mapInArrow(run, "row long, doc_id long, n_bytes long, n_chars long, start long, part string")


def _encode_chunks(cut: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """Per chunk its tokens and the boundaries (with the tokens before each) in both of its overlaps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = library(path)
        ints = pa.list_(pa.int64())
        schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_chars", pa.int64()), ("start", pa.int64()), ("n", pa.int64()), ("head_at", ints), ("head_n", ints), ("tail_at", ints), ("tail_n", ints)])
        for batch in batches:
            out = []
            for x in batch.to_pylist():
                e = t.encode(x["part"], add_special_tokens=False)
                head, tail = boundaries(e, 0, overlap), boundaries(e, chunk, len(x["part"]) - MARGIN)
                shifted = [[x["start"] + p for p in side[0]] for side in (head, tail)]
                out.append({k: x[k] for k in ("row", "doc_id", "n_bytes", "n_chars", "start")} | {"n": len(e), "head_at": shifted[0], "head_n": head[1], "tail_at": shifted[1], "tail_n": tail[1]})
            yield pa.RecordBatch.from_pylist(out, schema)

    return cut.mapInArrow(run, "row long, doc_id long, n_bytes long, n_chars long, start long, n long, head_at array<long>, head_n array<long>, tail_at array<long>, tail_n array<long>")


def _spliced(encoded: DataFrame, chunk: int) -> DataFrame:
    """Per document: n_tokens, or null if some neighbours share no boundary.

    The first common boundary of each pair of neighbours ends the left chunk's
    share and begins the right one's, so a chunk counts its tokens before its
    tail's splice, less those before its head's splice.
    """
    right = encoded.select(F.col("row"), (F.col("start") - chunk).alias("start"), F.col("head_at").alias("r_at"), F.col("head_n").alias("r_n"))
    pair = encoded.join(right, ["row", "start"], "left").withColumn("common", F.array_min(F.array_intersect("tail_at", "r_at")))
    left_n = F.element_at("tail_n", F.array_position("tail_at", F.col("common")).cast("int"))
    right_n = F.element_at("r_n", F.array_position("r_at", F.col("common")).cast("int"))
    share = F.when(F.col("r_at").isNull(), F.col("n")).when(F.col("common").isNotNull(), left_n - right_n)
    return (
        pair.withColumn("share", share)
        .groupBy("row")
        .agg(F.first("doc_id").alias("doc_id"), F.first("n_bytes").alias("n_bytes"), F.max("n_chars").alias("n_chars"), F.sum("share").alias("n_tokens"), F.max(F.col("share").isNull()).alias("failed"))
    )


def count_tokens(spark: SparkSession, docs: DataFrame, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens for every row of ``docs`` (doc_id, text; other columns are ignored).

    Null text counts as empty: 0 bytes, 0 tokens. Repeated rows give repeated
    results. An empty table gives an empty result.
    """
    short = _whole(docs, path, chunk)
    root = shared_dir(spark, "tokens")
    huge = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").where(F.length("text") > chunk)
    huge = materialize(huge, f"{root}/huge")
    out, width, step = short, overlap, 0
    while not huge.isEmpty():
        cut = _cut(huge, chunk, width).repartition("row", "start")
        encoded = materialize(_encode_chunks(cut, path, chunk, width), f"{root}/encoded{step}")
        spliced = materialize(_spliced(encoded, chunk), f"{root}/spliced{step}")
        out = out.unionByName(spliced.where("not failed").select("doc_id", "n_bytes", "n_tokens"))
        huge = huge.join(spliced.where("failed").select("row"), "row")
        width, step = width * 4, step + 1
    return out

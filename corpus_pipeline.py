"""The corpus pipeline: toxicity, exact dedup, near-dedup, mixing, encoding.

Each stage takes all documents that the stage before it kept and returns
documents with the same columns; the last one adds the tokens. ``run`` writes
every stage's result as Parquet to the shared folder and reads it back.

All stages need the columns doc_id and text (mixing also lang and source) and
carry every other column along. Null texts count as empty, null ids are rows of
their own, and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leafray.llm import bpe, exact_dedup, minhash, mixing, mixing_queries, toxicity
from leafray.llm.common import materialize, shared_dir, tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose text scores below one half, judged row by row.

    Repeated rows share their fate, since their texts do; empty texts score by
    the share of toxic labels. Without labels nothing goes.
    """
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with equal text (runs of white space count as one space): the smallest doc_id, null last.

    All empty texts are one group; of rows that repeat doc_id and text, one stays.
    """
    return exact_dedup.drop_copies(spark, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies (five-word shingles, similarity 0.75): the smallest doc_id, null last.

    Texts without words link with nothing and stay.
    """
    return minhash.drop_near_copies(spark, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mixture, once for each epoch they are read in; a text in which a budget ends is cut there.

    Documents without words have no tokens to take and are not in it. Null
    languages and sources are leaves of their own.
    """
    return mixing.mixed_documents(spark, docs, **mixing_queries.production())


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns but the text, and n_tokens, ids and round_trip: the ids of each whole text, checked to decode to it.

    A null text has no ids. Columns that are named like the new ones are replaced.
    """
    return bpe.encode_checked(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("encode", encode),
]

#: The first stage is a learned score, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of ``sf_dir`` through all stages."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = shared_dir(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"{root}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}

"""Training samples and hold-out folds for the learned scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string")) % folds


def sample(labels: DataFrame, label: str, trained: Column, rows: int) -> DataFrame:
    """At most ``rows`` labelled ids (doc_id, label) in an order seeded by the id; bounded, so it may be broadcast.

    Rows without id or label are left out. Of repeated ids the larger label counts.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).where(trained)
    one = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    return one.orderBy(F.xxhash64("doc_id", F.lit(17)), "doc_id").limit(rows)

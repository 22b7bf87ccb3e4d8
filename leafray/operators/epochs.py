"""Epochs of a file or receiver: ranges, completeness, coverage, conformance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafray.functions import gnss
from leafray.functions.columns import micros, ratio


def in_range(df: DataFrame, start, end, epoch: str = "epoch") -> DataFrame:
    """Rows of the closed time range; the predicate reaches the scan."""
    return df.where(F.col(epoch).between(F.lit(start), F.lit(end)))


def intervals(df: DataFrame, by: Sequence[str], epoch: str = "epoch") -> DataFrame:
    """Per group: n_epochs, the most frequent spacing of distinct epochs in whole seconds (of equally frequent ones the smallest), and n_epochs times it."""
    epochs = df.select(*by, micros(F.col(epoch)).alias("t_")).distinct()
    step = F.floor((F.col("t_") - F.lag("t_").over(Window.partitionBy(*by).orderBy("t_"))) / 1_000_000)
    gaps = epochs.withColumn("gap_", step).where("gap_ > 0").groupBy(*by, "gap_").agg(F.count(F.lit(1)).alias("c_"))
    mode = gaps.groupBy(*by).agg(F.max(F.struct("c_", (-F.col("gap_")).alias("g_"))).alias("m_")).select(*by, (-F.col("m_.g_")).alias("sampling"))
    out = epochs.groupBy(*by).agg(F.count(F.lit(1)).alias("n_epochs")).join(mode, list(by), "left")
    return out.withColumn("dump", F.col("n_epochs") * F.col("sampling"))


def completeness(df: DataFrame, by: Sequence[str], dump_seconds: int | None = None, sampling_seconds: int | None = None, epoch: str = "epoch") -> DataFrame:
    """Per group whether its epochs fill the dump interval: ``intervals`` and missing, complete.

    What isn't given is inferred; a group whose sampling can't be inferred (one
    epoch) is not complete.
    """
    known = intervals(df, by, epoch)
    if sampling_seconds is not None:
        known = known.withColumn("sampling", F.lit(sampling_seconds).cast("long"))
    dump = F.lit(dump_seconds).cast("long") if dump_seconds is not None else F.col("n_epochs") * F.col("sampling")
    known = known.withColumn("dump", dump)
    wanted = F.floor(ratio(F.col("dump"), F.col("sampling")))
    return known.withColumn("missing", wanted - F.col("n_epochs")).withColumn("complete", F.coalesce(F.col("n_epochs") * F.col("sampling") == F.col("dump"), F.lit(False)))


def coverage_compatible(main: DataFrame, processed: DataFrame, requested: tuple | None = None, least: float = 0.7, epoch: str = "epoch") -> DataFrame:
    """One row: the date ranges of both, the share of the main span in days that the processed one has, and whether that is enough.

    With ``requested`` (first and last date) its ends must lie within the
    processed range instead, a day's grace allowed on the far side of each.
    """
    span = lambda df, tag: df.agg(F.to_date(F.min(epoch)).alias(f"{tag}_start"), F.to_date(F.max(epoch)).alias(f"{tag}_end"))
    both = span(main, "main").join(F.broadcast(span(processed, "processed")))
    days = lambda tag: F.datediff(F.col(f"{tag}_end"), F.col(f"{tag}_start"))
    both = both.withColumn("share", F.coalesce(ratio(days("processed"), days("main")), F.lit(0.0)))
    if requested is None:
        return both.withColumn("compatible", F.col("share") >= least)
    start, end = (F.lit(d).cast("date") for d in requested)
    a, b = F.col("processed_start"), F.col("processed_end")
    ok = start.between(a, F.date_add(b, 1)) & end.between(F.date_sub(a, 1), b)
    return both.withColumn("compatible", F.coalesce(ok, F.lit(False)))


def conformance(obs: DataFrame, by: Sequence[str] = ("receiver",)) -> DataFrame:
    """Per group: rows and how many break each rule: malformed signals, repeated (epoch, sid), negative or absurd SNR, missing epochs; and whether none does."""
    rules = {
        "malformed_sid": ~F.coalesce(gnss.valid_sid(F.col("sid")), F.lit(False)),
        "bad_snr": F.coalesce((F.col("snr") < 0) | (F.col("snr") > 70), F.lit(False)),
        "no_epoch": F.col("epoch").isNull(),
    }
    once = obs.groupBy(*by, "epoch", "sid").agg(F.count(F.lit(1)).alias("n_"), *[F.sum(c.cast("long")).alias(n) for n, c in rules.items()])
    out = once.groupBy(*by).agg(F.sum("n_").alias("n_rows"), F.sum(F.col("n_") - 1).alias("repeated"), *[F.sum(n).alias(n) for n in rules])
    broken = sum((F.col(n) for n in rules), F.col("repeated"))
    return out.withColumn("conforms", broken == 0)


def ragged_offsets(counts: DataFrame, key: str, count: str, width: int = 65_536) -> DataFrame:
    """``counts`` with the running total of ``count`` before each key, in key order.

    Totals of key ranges of ``width`` are summed first (one row a range), so the
    rows themselves are only ordered within their range.
    """
    c = counts.withColumn("part_", F.floor(F.col(key) / width))
    parts = c.groupBy("part_").agg(F.sum(count).alias("s_"))
    earlier = parts.select("part_", F.coalesce(F.sum("s_").over(Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base_"))
    within = F.coalesce(F.sum(count).over(Window.partitionBy("part_").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return c.withColumn("within_", within).join(earlier, "part_").withColumn("offset", F.col("base_") + F.col("within_")).drop("part_", "within_", "base_")

"""Nearest as-of, interval and validity joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafray.functions.columns import micros
from leafray.operators.ordered import around


def nearest_asof(left: DataFrame, right: DataFrame, keys: Sequence[str], time: str, values: Sequence[str], tolerance_seconds: float | None = None, part_seconds: int = 86_400) -> DataFrame:
    """``left`` with the values of the row of ``right`` nearest in time per key, and ``asof_gap`` in seconds; ties take the earlier.

    No range join: each left row takes the last and the next right row of its
    key (``ordered.around``), in parts of ``part_seconds``. Of right rows at one
    instant the greatest values stay. Without a match the values are null.
    """
    r = right.groupBy(*keys, micros(F.col(time)).alias("t_")).agg(F.max(F.struct(*values)).alias("v_"))
    r = r.withColumn("knot_", F.struct("t_", "v_"))
    known = around(r, left.withColumn("t_", micros(F.col(time))), keys, "t_", "knot_", part_seconds * 1_000_000)
    before, after = F.col("t_") - F.col("before_.t_"), F.col("after_.t_") - F.col("t_")
    use = F.when(F.col("after_").isNull() | (before <= after), F.col("before_")).otherwise(F.col("after_"))
    known = known.withColumn("use_", use).withColumn("asof_gap", F.abs(F.col("use_.t_") - F.col("t_")) / 1e6)
    if tolerance_seconds is not None:
        known = known.withColumn("use_", F.when(F.col("asof_gap") <= tolerance_seconds, F.col("use_"))).withColumn("asof_gap", F.when(F.col("use_").isNotNull(), F.col("asof_gap")))
    return known.select(*left.columns, *[F.col(f"use_.v_.{v}").alias(v) for v in values], "asof_gap")


def overlapping(left: DataFrame, right: DataFrame, bucket_seconds: int, closed: bool = True, on: Sequence[str] = (), open_ends: bool = True) -> DataFrame:
    """Pairs of rows whose intervals [start, end] overlap: all columns of both (those of ``right`` with ``_2``).

    Each interval is listed in the time buckets it touches, so pairs meet in an
    equi-join; a pair is kept in the bucket where its common part begins. A
    null end lasts until year 9999; where it is known that there is none,
    ``open_ends`` = False spares the pass that finds how far buckets must go.
    Half-open intervals don't meet at their ends.
    """
    width = bucket_seconds * 1_000_000
    last = F.lit(253_402_300_799_000_000)

    def spread(df: DataFrame, tag: str) -> DataFrame:
        named = df.select(*[F.col(c).alias(f"{c}{tag}") for c in df.columns])
        a, b = micros(F.col(f"start{tag}")), F.coalesce(micros(F.col(f"end{tag}")), last)
        named = named.withColumn(f"a{tag}_", a).withColumn(f"b{tag}_", b).where(F.col(f"a{tag}_") <= F.col(f"b{tag}_"))
        return named

    l, r = spread(left, ""), spread(right, "_2")
    # open intervals would fill buckets without end, so buckets stop where the other side does
    stop = l.agg(F.max("a_").alias("m")).unionByName(r.agg(F.max("a_2_").alias("m"))).agg(F.max("m").alias("stop_"))

    def put(df: DataFrame, tag: str) -> DataFrame:
        first, end = F.floor(F.col(f"a{tag}_") / width), F.col(f"b{tag}_")
        if open_ends:
            df, end = df.join(F.broadcast(stop)), F.least(end, F.col("stop_"))
        return df.withColumn("bucket_", F.explode(F.sequence(first, F.greatest(first, F.floor(end / width))))).drop("stop_")

    l, r = put(l, ""), put(r, "_2")
    same = (l["bucket_"] == r["bucket_"])
    for k in on:
        same = same & (F.col(k) == F.col(f"{k}_2"))
    meet = (F.col("a_") <= F.col("b_2_")) & (F.col("b_") >= F.col("a_2_")) if closed else (F.col("a_") < F.col("b_2_")) & (F.col("b_") > F.col("a_2_"))
    pairs = l.join(r, same & meet & (l["bucket_"] == F.floor(F.greatest("a_", "a_2_") / width)))
    return pairs.drop("bucket_", "a_", "b_", "a_2_", "b_2_")


def _reached(batch: DataFrame, ledger: DataFrame, width: int) -> DataFrame:
    """(a_, b_) of the batch's intervals that meet a ledger interval: the largest end among those that start by b_ is at least a_."""
    ends = ledger.groupBy(F.col("a_").alias("t_")).agg(F.max("b_").alias("end_")).withColumn("low_", F.lit(None).cast("long"))
    asked = batch.select("a_", "b_").distinct().select(F.col("b_").alias("t_"), F.lit(None).cast("long").alias("end_"), F.col("a_").alias("low_"))
    both = ends.unionByName(asked).withColumn("k_", F.floor(F.col("t_") / width))
    before = Window.orderBy("k_").rowsBetween(Window.unboundedPreceding, -1)
    earlier = both.groupBy("k_").agg(F.max("end_").alias("e_")).select("k_", F.max("e_").over(before).alias("earlier_"))
    so_far = Window.partitionBy("k_").orderBy("t_").rangeBetween(Window.unboundedPreceding, 0)
    known = both.withColumn("here_", F.max("end_").over(so_far)).where("low_ is not null").join(earlier, "k_")
    return known.where(F.greatest("here_", "earlier_") >= F.col("low_")).select(F.col("low_").alias("a_"), F.col("t_").alias("b_"))


def _inside(batch: DataFrame, width: int) -> DataFrame:
    """Distinct (file_hash, a_, b_) of ``batch`` that lie inside an interval of another hash.

    Of the intervals that start by a_, the greatest (end, hash) and the largest
    end of any other hash decide. That second end is the largest of the smaller
    ends wherever an interval meets a greatest one of another hash before it.
    """
    rows = batch.select("file_hash", "a_", "b_").distinct().withColumn("k_", F.floor(F.col("a_") / width)).withColumn("x_", F.struct("b_", "file_hash"))

    def lost(x: str, w) -> Column:
        top = F.max(x).over(w.rowsBetween(Window.unboundedPreceding, -1))
        return F.when(top["file_hash"] != F.col(x)["file_hash"], F.least(top["b_"], F.col(x)["b_"]))

    of_bucket = Window.partitionBy("k_")
    rows = rows.withColumn("lost_", lost("x_", of_bucket.orderBy("a_", "b_", "file_hash")))
    so_far = of_bucket.orderBy("a_").rangeBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("top_", F.max("x_").over(so_far)).withColumn("second_", F.max("lost_").over(so_far))
    buckets = rows.groupBy("k_").agg(F.max("x_").alias("x_"), F.max("lost_").alias("lost_"))
    in_order = Window.orderBy("k_")
    buckets = buckets.withColumn("lost_", F.greatest("lost_", lost("x_", in_order)))
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    earlier = buckets.select("k_", F.max("x_").over(before).alias("top_before_"), F.max("lost_").over(before).alias("second_before_"))
    other = lambda top, second: F.when(F.col(top)["file_hash"] != F.col("file_hash"), F.col(top)["b_"]).otherwise(F.col(second))
    found = rows.join(earlier, "k_").where(F.greatest(other("top_", "second_"), other("top_before_", "second_before_")) >= F.col("b_"))
    return found.select("file_hash", "a_", "b_")


def ledger_verdicts(batch: DataFrame, ledger: DataFrame, bucket_seconds: int = 86_400) -> DataFrame:
    """``batch`` (file_hash, start, end) with why to skip it: hash_match, temporal_overlap, contained, or null to ingest.

    A hash known to the ledger comes first, then any closed overlap with a
    ledger interval, then lying inside another file of the batch (of two equal
    intervals both do). A null hash never matches the ledger. No pairs are
    formed: running maxima of the ends, per time bucket, decide.
    """
    width = bucket_seconds * 1_000_000
    known = ledger.select("file_hash").where("file_hash is not null").distinct().withColumn("by_hash_", F.lit(True))
    a, b = micros(F.col("start")), F.coalesce(micros(F.col("end")), F.lit(253_402_300_799_000_000))
    marked = batch.join(known, "file_hash", "left").withColumn("a_", a).withColumn("b_", b)
    times = marked.where("file_hash is not null and a_ <= b_")
    by_time = _reached(times, ledger.select(a.alias("a_"), b.alias("b_")).where("a_ <= b_"), width).withColumn("by_time_", F.lit(True))
    # an open end is neither inside another interval nor around one
    inside = _inside(times.where("end is not null"), width).withColumn("inside_", F.lit(True))
    out = marked.join(by_time, ["a_", "b_"], "left").join(inside, ["file_hash", "a_", "b_"], "left")
    reason = F.when(F.col("by_hash_"), "hash_match").when(F.col("file_hash").isNotNull() & F.col("by_time_"), "temporal_overlap").when(F.col("inside_") & F.col("end").isNotNull(), "contained")
    return out.withColumn("reason", reason).select(*batch.columns, "reason")


def valid_at(facts: DataFrame, periods: DataFrame, key: str, day: str, values: Sequence[str], bucket_days: int = 366) -> DataFrame:
    """``facts`` with the values of the period of the same key that holds the day (open ends last); of several the earliest start.

    Periods are listed in buckets of days, so the join is an equi-join on key
    and bucket.
    """
    number = lambda c: F.datediff(c, F.to_date(F.lit("1980-01-01")))
    last = facts.agg(F.max(number(F.col(day))).alias("last_"))
    p = periods.select(F.col(key).alias("k_"), number(F.col("start")).alias("a_"), F.coalesce(number(F.col("end")), F.lit(2**30)).alias("b_"), *values).join(F.broadcast(last))
    bucket = F.sequence(F.floor(F.col("a_") / bucket_days), F.greatest(F.floor(F.col("a_") / bucket_days), F.floor(F.least(F.col("b_"), F.coalesce("last_", F.lit(0))) / bucket_days)))
    p = p.withColumn("u_", F.explode(bucket)).drop("last_")
    f = facts.select("*", number(F.col(day)).alias("d_"), F.monotonically_increasing_id().alias("id_"))
    hit = f.join(p, (F.col(key) == F.col("k_")) & (F.floor(F.col("d_") / bucket_days) == F.col("u_")) & F.col("d_").between(F.col("a_"), F.col("b_")), "left")
    first = Window.partitionBy("id_").orderBy(F.col("a_").asc_nulls_last(), *values)
    return hit.withColumn("n_", F.row_number().over(first)).where("n_ = 1").select(*facts.columns, *values)


def in_ranges(facts: DataFrame, ranges: DataFrame, value: str, columns: Sequence[str]) -> DataFrame:
    """``facts`` with the columns of the first range (lo, hi, by lo) that holds a small integer value.

    Ranges are listed by value, so this is an equi-join on a dimension whose
    size is the width of the ranges.
    """
    one = ranges.withColumn("v_", F.explode(F.sequence(F.col("lo"), F.col("hi")))).groupBy("v_").agg(F.min(F.struct("lo", "hi", *columns)).alias("r_"))
    out = facts.join(one, F.col(value) == F.col("v_"), "left")
    return out.select(*facts.columns, *[F.col(f"r_.{c}").alias(c) for c in columns])


def latest(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The row of each key that comes last in ``order``; by aggregation, so a hot key is combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max(F.struct(F.col(order).alias("o_"), *rest)).alias("b_"))
    return best.select(*keys, *[F.col(f"b_.{c}").alias(c) for c in rest]).select(*df.columns)


def first_seen(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min(F.struct(F.col(order).alias("o_"), *rest)).alias("b_"))
    return best.select(*keys, *[F.col(f"b_.{c}").alias(c) for c in rest]).select(*df.columns)


def read_deduplicated(obs: DataFrame, ledger: DataFrame) -> DataFrame:
    """Observations inside any interval of the ledger's latest row per (start, end), one per epoch and signal (the last ingested)."""
    current = latest(ledger, ["start", "end"], "written_at").select("start", "end")
    days = current.withColumn("day_", F.explode(F.sequence(F.to_date("start"), F.to_date("end"))))
    inside = obs.join(days, (F.to_date("epoch") == F.col("day_")) & F.col("epoch").between(F.col("start"), F.col("end")), "left_semi")
    return latest(inside, ["receiver", "epoch", "sid"], "ingest_seq")


def replace_interval(old: DataFrame, new: DataFrame, start, end) -> DataFrame:
    """``old`` without epochs of the closed interval, and ``new``."""
    return old.where(~F.col("epoch").between(F.lit(start), F.lit(end))).unionByName(new, allowMissingColumns=True)


def shared_labels(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    return a.select(column).intersect(b.select(column))


def dropped_labels(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    return a.select(column).distinct().exceptAll(b.select(column).distinct())


def changes(records: DataFrame, key: str, value: str, start: str = "start") -> DataFrame:
    """Records whose value differs from the key's record before."""
    w = Window.partitionBy(key).orderBy(start)
    return records.withColumn("previous", F.lag(value).over(w)).where(F.col("previous").isNotNull() & (F.col("previous") != F.col(value)))

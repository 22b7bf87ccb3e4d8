"""Neighbours in time, marks that hold for the lines below them and exact quantiles, in linear passes that spread over tasks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranks that a quantile sketch may be off, as a share of all rows, is one in this many.
ACCURACY = 10_000
#: Lines whose marks are listed together.
STRETCH = 4096


def _same(keys: Sequence[str], tag: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{k}{tag}")) for k in keys])


def around(knots: DataFrame, targets: DataFrame, keys: Sequence[str], time: str, knot: str, width: float) -> DataFrame:
    """``targets`` with ``before_`` and ``after_``: the ``knot`` struct of the last knot at or before and of the first at or after each, per key.

    Keys are split into parts of ``width`` on the time axis, so one key with
    most of the rows spreads over tasks; within a part both directions are
    running last values. What lies beyond a part comes from one row per part:
    its first and last knot.
    """
    part = F.floor(F.col(time) / width).alias("part_")
    k = knots.select(*keys, F.col(time).alias("at_"), part, F.col(knot).alias("own_"))
    t = targets.select(*keys, F.col(time).alias("at_"), part, F.struct(*targets.columns).alias("row_"))
    both = k.unionByName(t, allowMissingColumns=True)
    place = Window.partitionBy(*keys, "part_")
    so_far = lambda order: F.last("own_", ignorenulls=True).over(place.orderBy(order).rangeBetween(Window.unboundedPreceding, 0))
    met = both.withColumn("before_", so_far(F.col("at_"))).withColumn("after_", so_far(F.col("at_").desc())).where("row_ is not null")

    ends = k.groupBy(*keys, "part_").agg(F.min_by("own_", "at_").alias("first_"), F.max_by("own_", "at_").alias("last_"))
    parts = ends.unionByName(t.select(*keys, "part_").distinct(), allowMissingColumns=True)
    parts = parts.groupBy(*keys, "part_").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("first_", "last_")])
    of_key = Window.partitionBy(*keys)
    beyond = lambda c, order: F.last(c, ignorenulls=True).over(of_key.orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(*[F.col(c).alias(f"{c}_p") for c in keys], F.col("part_").alias("part__p"), beyond("last_", F.col("part_")).alias("earlier_"), beyond("first_", F.col("part_").desc()).alias("later_"))
    met = met.join(parts, _same([*keys, "part_"], "_p"))
    return met.select("row_.*", F.coalesce("before_", "earlier_").alias("before_"), F.coalesce("after_", "later_").alias("after_"))


def last_said(lines: DataFrame, mark: Column, name: str) -> DataFrame:
    """``lines`` with ``name``: the last non-null ``mark`` at or before each line of its file; for few marks in many lines.

    ``lines`` have file and line (start, row), as ``text.numbered_lines`` gives
    them. Each stretch of rows lists its marks and the last one before it, and
    its lines take theirs from the list. So a file spreads over tasks; only one
    row per stretch goes through a window over the file.
    """
    row = F.col("line.row")
    stretch = F.floor(row / STRETCH)
    place = ["file", F.col("line.start").alias("start_"), stretch.alias("stretch_")]
    marks = lines.select(*place, F.struct(row.alias("row"), mark.alias("mark")).alias("said_")).where("said_.mark is not null")
    parts = lines.groupBy(*place).agg(F.min("line.row").alias("first_")).unionByName(marks, allowMissingColumns=True)
    parts = parts.groupBy("file", "start_", "stretch_").agg(F.min("first_").alias("first_"), F.array_sort(F.collect_list("said_")).alias("said_"))
    before = Window.partitionBy("file").orderBy("start_", "stretch_").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("earlier_", F.last(F.try_element_at("said_", F.lit(-1))["mark"], ignorenulls=True).over(before))
    # rows count on over all files, so a stretch may have the end of one and the beginning of another
    lists = parts.groupBy("stretch_").agg(F.array_sort(F.collect_list(F.struct("first_", "earlier_", "said_"))).alias("parts_"))
    met = lines.withColumn("stretch_", stretch).join(lists, "stretch_")
    own = F.try_element_at(F.filter("parts_", lambda p: p["first_"] <= row), F.lit(-1))
    said = F.try_element_at(F.filter(own["said_"], lambda m: m["row"] <= row), F.lit(-1))
    return met.select(*lines.columns, F.coalesce(said["mark"], own["earlier_"]).alias(name))


def exact_quantiles(df: DataFrame, value: Column, probabilities: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Linear quantiles of the non-null values per group (few groups with many rows): ``by`` and the array ``q``.

    A mergeable sketch brackets each rank; a second pass counts, in one
    aggregation, the values below the bracket and those inside it, of which only
    the wanted rank is read off.
    So no task holds a group's values; the bracket has about 4 / ACCURACY of its
    rows, counted by value; of no more than 10 ACCURACY values it has all.
    Without groups, an empty table gives an empty array.
    """
    x = df.select(*by, value.cast("double").alias("v_")).where("v_ is not null")
    margin = 2 / ACCURACY
    cuts = [max(0.0, min(1.0, p + d)) for p in probabilities for d in (-margin, margin)]
    sketch = x.groupBy(*by).agg(F.count(F.lit(1)).alias("n_"), F.percentile_approx("v_", cuts, ACCURACY).alias("e_"), F.min("v_").alias("min_"), F.max("v_").alias("max_"))
    brackets = []
    for i, p in enumerate(probabilities):
        few = F.col("n_") <= 10 * ACCURACY
        low = F.col("min_") if p <= margin else F.when(few, F.col("min_")).otherwise(F.col("e_")[2 * i])
        high = F.col("max_") if p >= 1 - margin else F.when(few, F.col("max_")).otherwise(F.col("e_")[2 * i + 1])
        brackets.append(F.struct(F.lit(i).alias("i"), low.alias("low"), high.alias("high"), (F.lit(p) * (F.col("n_") - 1)).alias("rank")))
    known = sketch.select(*[F.col(b).alias(f"{b}_g") for b in by], F.array(*brackets).alias("b_"))
    met = x.join(known, _same(by, "_g")) if by else x.join(F.broadcast(known))
    # values below a bracket count as null, which comes first in order; those above it don't count
    upto_high = F.transform(F.filter("b_", lambda b: F.col("v_") <= b["high"]), lambda b: F.struct(b.alias("b"), F.when(F.col("v_") >= b["low"], F.col("v_")).alias("v")))
    inside = met.select(*by, F.explode(upto_high).alias("e_")).groupBy(*by, F.col("e_.b").alias("b_"), F.col("e_.v").alias("v_")).agg(F.count(F.lit(1)).alias("c_"))
    upto = F.sum("c_").over(Window.partitionBy(*by, "b_").orderBy("v_").rowsBetween(Window.unboundedPreceding, 0))
    at = lambda rank: F.min(F.when(F.col("upto_") > rank(F.col("b_.rank")), F.col("v_")))
    found = inside.withColumn("upto_", upto).groupBy(*by, "b_").agg(at(F.floor).alias("lo_"), at(F.ceil).alias("hi_"))
    share = F.col("b_.rank") - F.floor("b_.rank")
    one = F.struct(F.col("b_.i").alias("i"), ((1 - share) * F.col("lo_") + share * F.col("hi_")).alias("q"))
    return found.groupBy(*by).agg(F.transform(F.sort_array(F.collect_list(one)), lambda s: s["q"]).alias("q"))

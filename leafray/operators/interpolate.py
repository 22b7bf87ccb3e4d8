"""Orbit and clock interpolation in closed form.

Knots learn their successor by ``lead``; targets meet the knot before them in
an ordered pass over parts of the time axis, so nothing is joined by range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafray.functions.columns import micros
from leafray.operators.ordered import around

AXES = ("x", "y", "z")


def velocities(orbits: DataFrame, key: str = "sv", axes: Sequence[str] = AXES) -> DataFrame:
    """Adds v<axis> per second: central differences over two median steps, one-sided at the ends."""
    w = Window.partitionBy(key).orderBy("t_")
    o = orbits.withColumn("t_", micros(F.col("epoch")) / 1e6).withColumn("gap_", F.col("t_") - F.lag("t_").over(w))
    step = o.groupBy(key).agg(F.median("gap_").alias("step_"))
    o = o.join(step, key)
    for a in axes:
        before, after = F.lag(a).over(w), F.lead(a).over(w)
        d = F.when(before.isNotNull() & after.isNotNull(), (after - before) / (2 * F.col("step_")))
        o = o.withColumn(f"v{a}", F.coalesce(d, (after - F.col(a)) / F.col("step_"), (F.col(a) - before) / F.col("step_")))
    return o.drop("t_", "gap_", "step_")


def hermite(z: Column, h: Column, p0: Column, v0: Column, p1: Column, v1: Column) -> Column:
    z2, z3 = z * z, z * z * z
    return (2 * z3 - 3 * z2 + 1) * p0 + (z3 - 2 * z2 + z) * h * v0 + (-2 * z3 + 3 * z2) * p1 + (z3 - z2) * h * v1


def hermite_speed(z: Column, h: Column, p0: Column, v0: Column, p1: Column, v1: Column) -> Column:
    z2 = z * z
    return ((6 * z2 - 6 * z) * (p0 - p1)) / h + (3 * z2 - 4 * z + 1) * v0 + (3 * z2 - 2 * z) * v1


def _meet(knots: DataFrame, targets: DataFrame, key: str, knot: Column) -> DataFrame:
    """Targets (key, epoch) with the struct ``k_`` of the knot at or before them, or the first one."""
    k = knots.select(key, "t_", knot.alias("own_"))
    t = targets.select(key, "epoch", (F.floor(micros(F.col("epoch")) / 1e6)).cast("double").alias("t_"))
    met = around(k, t, [key], "t_", "own_", 86_400.0)
    return met.withColumn("k_", F.coalesce("before_", "after_"))


def positions(orbits: DataFrame, targets: DataFrame, key: str = "sv", axes: Sequence[str] = AXES) -> DataFrame:
    """Cubic Hermite positions and velocities at ``targets`` (key, epoch); the first and last pieces reach beyond the ends.

    Time counts in whole seconds. Knots without position or velocity are left
    out; a satellite with fewer than two knots gives nulls.
    """
    cols = [c for a in axes for c in (a, f"v{a}")]
    w = Window.partitionBy(key).orderBy("t_")
    k = orbits.dropna(subset=cols).withColumn("t_", F.floor(micros(F.col("epoch")) / 1e6).cast("double"))
    k = k.withColumn("t1_", F.lead("t_").over(w)).withColumns({f"{c}_1": F.lead(c).over(w) for c in cols})
    piece = F.struct(F.col("t_").alias("t0"), F.col("t1_").alias("t1"), *cols, *[f"{c}_1" for c in cols])
    # the last knot has no piece of its own, so targets after it fall to the piece before it
    met = _meet(k.where("t1_ is not null"), targets, key, piece)
    z, h = (F.col("t_") - F.col("k_.t0")) / (F.col("k_.t1") - F.col("k_.t0")), F.col("k_.t1") - F.col("k_.t0")
    parts = lambda a: [F.col(f"k_.{n}") for n in (a, f"v{a}", f"{a}_1", f"v{a}_1")]
    return met.select(key, "epoch", *[hermite(z, h, *parts(a)).alias(a) for a in axes], *[hermite_speed(z, h, *parts(a)).alias(f"v{a}") for a in axes])


def linear(orbits: DataFrame, targets: DataFrame, key: str = "sv", axes: Sequence[str] = AXES) -> DataFrame:
    """Straight lines between knots; null outside their range."""
    w = Window.partitionBy(key).orderBy("t_")
    k = orbits.dropna(subset=list(axes)).withColumn("t_", F.floor(micros(F.col("epoch")) / 1e6).cast("double"))
    k = k.withColumn("t1_", F.lead("t_").over(w)).withColumns({f"{a}_1": F.lead(a).over(w) for a in axes})
    piece = F.struct(F.col("t_").alias("t0"), F.col("t1_").alias("t1"), *axes, *[f"{a}_1" for a in axes])
    met = _meet(k, targets, key, piece)
    z = (F.col("t_") - F.col("k_.t0")) / (F.col("k_.t1") - F.col("k_.t0"))
    on = F.col("t_") == F.col("k_.t0")
    inside = (F.col("t_") > F.col("k_.t0")) & (F.col("t_") <= F.col("k_.t1"))
    return met.select(key, "epoch", *[F.when(on, F.col(f"k_.{a}")).when(inside, F.col(f"k_.{a}") + z * (F.col(f"k_.{a}_1") - F.col(f"k_.{a}"))).alias(a) for a in axes])


def clock_segments(clocks: DataFrame, key: str = "sv", jump: float = 1e-6) -> DataFrame:
    """Adds the number of the segment between jumps larger than ``jump`` of successive valid clocks."""
    w = Window.partitionBy(key).orderBy("epoch")
    c = clocks.where(F.col("clock").isNotNull())
    new = F.coalesce(F.abs(F.col("clock") - F.lag("clock").over(w)) > jump, F.lit(False)).cast("int")
    return c.withColumn("new_", new).withColumn("segment", F.sum("new_").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("new_")


def clocks(known: DataFrame, targets: DataFrame, key: str = "sv", jump: float = 1e-6) -> DataFrame:
    """Clock at ``targets``: linear within a segment of two or more values, ends included; null between and outside segments."""
    w = Window.partitionBy(key).orderBy("t_")
    k = clock_segments(known, key, jump).withColumn("t_", micros(F.col("epoch")) / 1e6)
    k = k.withColumns({"t1_": F.lead("t_").over(w), "c1_": F.lead("clock").over(w), "s1_": F.lead("segment").over(w), "s0_": F.lag("segment").over(w)})
    k = k.withColumn("alone_", ~(F.coalesce(F.col("s0_") == F.col("segment"), F.lit(False)) | F.coalesce(F.col("s1_") == F.col("segment"), F.lit(False))))
    met = _meet(k, targets, key, F.struct(F.col("t_").alias("t0"), "clock", "segment", "t1_", "c1_", "s1_", "alone_"))
    on = (F.col("t_") == F.col("k_.t0")) & ~F.col("k_.alone_")
    inside = (F.col("t_") > F.col("k_.t0")) & (F.col("k_.s1_") == F.col("k_.segment"))
    z = (F.col("t_") - F.col("k_.t0")) / (F.col("k_.t1_") - F.col("k_.t0"))
    return met.select(key, "epoch", F.when(on, F.col("k_.clock")).when(inside, F.col("k_.clock") + z * (F.col("k_.c1_") - F.col("k_.clock"))).alias("clock"))


def day_targets(keys: DataFrame, day: str, seconds: int = 5, key: str = "sv") -> DataFrame:
    """Every ``seconds`` of a day for each distinct key."""
    start = F.to_timestamp_ntz(F.lit(day))
    steps = F.sequence(start, start + F.expr("interval 1 day") - F.expr(f"interval {seconds} second"), F.expr(f"interval {seconds} second"))
    return keys.select(key).distinct().withColumn("epoch", F.explode(steps))


def coverage(df: DataFrame, value: str, key: str = "sv", least: float = 80.0) -> DataFrame:
    """Per key the share of rows with a value, and whether it is enough."""
    share = 100.0 * F.count(value) / F.count(F.lit(1))
    return df.groupBy(key).agg(share.alias("coverage")).withColumn("enough", F.col("coverage") >= least)

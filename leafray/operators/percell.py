"""Analysis of per-cell series (cell_id, time, value, weight, count)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafray.functions.columns import ratio
from leafray.operators.ordered import exact_quantiles


def stats(percell: DataFrame, stat: str = "median") -> DataFrame:
    """mean, median or std (population) over time per cell."""
    use = {"mean": F.avg, "median": F.median, "std": F.stddev_pop}[stat]
    return percell.groupBy("cell_id").agg(use("value").alias("value"))


def temporal_stats(percell: DataFrame) -> DataFrame:
    """Per cell the range, the slope against the index of all times (more than three values), and std / mean."""
    order = percell.select("time").distinct().withColumn("idx", F.row_number().over(Window.orderBy("time")) - 1)  # one row per time bin
    known = percell.join(order, "time")
    slope = F.regr_slope(F.col("value"), F.col("idx").cast("double"))
    return known.groupBy("cell_id").agg(
        (F.max("value") - F.min("value")).alias("range"),
        F.when(F.count("value") > 3, slope).alias("trend"),
        ratio(F.stddev_pop("value"), F.avg("value")).alias("cv"),
    )


def coverage(percell: DataFrame) -> DataFrame:
    """Per cell: observations and share of all times with a value, in percent."""
    times = percell.agg(F.countDistinct("time").alias("times"))
    sums = percell.groupBy("cell_id").agg(F.sum("count").alias("n_obs"), F.count("value").alias("n_times"))
    return sums.join(times).select("cell_id", "n_obs", (100.0 * F.col("n_times") / F.col("times")).alias("coverage"))


def diurnal_dynamics(percell: DataFrame, half_hours: bool = False) -> DataFrame:
    """Weighted mean over cells per time, then mean and population deviation over the times of each slot."""
    step = percell.groupBy("time").agg(ratio(F.sum(F.col("value") * F.col("weight")), F.sum(F.when(F.col("value").isNotNull(), F.col("weight")))).alias("m"))
    slot = F.hour("time") * 2 + F.floor(F.minute("time") / 30) if half_hours else F.hour("time")
    out = step.groupBy(slot.cast("int").alias("slot")).agg(F.avg("m").alias("mean"), F.stddev_pop("m").alias("std"), F.count("m").alias("n"))
    label = F.format_string("%02d:%02d", F.floor(F.col("slot") / 2).cast("int"), ((F.col("slot") % 2) * 30).cast("int"))
    return out.withColumn("label", label) if half_hours else out


def averaged_diurnal(series: list[DataFrame]) -> DataFrame:
    """Slots that all series have: mean of means, root of summed squares over N, summed counts."""
    both = reduce(DataFrame.unionByName, [diurnal_dynamics(s).withColumn("series", F.lit(i)) for i, s in enumerate(series)])
    out = both.where("mean is not null").groupBy("slot").agg(
        F.avg("mean").alias("mean"), (F.sqrt(F.sum(F.col("std") * F.col("std"))) / len(series)).alias("std"), F.sum("n").alias("n"), F.countDistinct("series").alias("k")
    )
    return out.where(F.col("k") == len(series)).drop("k")


def elevation_bins(percell: DataFrame, grid: DataFrame, width: int = 5) -> DataFrame:
    """Mean over time per cell, then mean and cells per bin of elevation (degrees) with its true centre."""
    mean = percell.groupBy("cell_id").agg(F.avg("value").alias("value"))
    elevation = F.round(90 - F.degrees("theta"), 9)  # centres lie on bin edges
    placed = mean.where("value is not null").join(grid.select("cell_id", elevation.alias("elevation")), "cell_id")
    bin_ = F.floor(F.col("elevation") / width)
    return placed.groupBy(bin_.cast("int").alias("elev_bin")).agg(F.avg("value").alias("mean"), F.count("value").alias("n_cells")).withColumn("centre", (F.col("elev_bin") + 0.5) * width)


TIME_KEYS = {"hour": F.hour, "week": F.weekofyear, "month": F.month}


def theta_time_heatmap(percell: DataFrame, grid: DataFrame, by: str = "hour", theta_bins: int = 9) -> DataFrame:
    """Mean per left-closed bin of theta and hour, ISO week or month (of any year)."""
    placed = percell.where("value is not null").join(grid.select("cell_id", "theta"), "cell_id")
    bin_ = F.least(F.lit(theta_bins - 1), F.floor(F.round(F.degrees("theta"), 9) / (90.0 / theta_bins))).cast("int")
    return placed.groupBy(bin_.alias("theta_bin"), TIME_KEYS[by](F.col("time")).alias(by)).agg(F.avg("value").alias("mean"), F.count("value").alias("n"))


def distributions(percell: DataFrame) -> DataFrame:
    """Quartiles and count of the values of each hour, instead of lists of all values; an hour's values meet in no one task."""
    known = percell.where("value is not null").select(F.hour("time").alias("hour"), "value")
    counts = known.groupBy("hour").agg(F.count("value").alias("n"))
    q = exact_quantiles(known, F.col("value"), (0.25, 0.5, 0.75), by=["hour"])
    return q.join(counts, "hour").select("hour", F.col("q")[0].alias("q1"), F.col("q")[1].alias("q2"), F.col("q")[2].alias("q3"), "n")


def fingerprint(df: DataFrame, *columns: str) -> Column:
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))

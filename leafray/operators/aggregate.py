"""Aggregation by cell, time and both."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafray.functions import solar
from leafray.functions.columns import micros, ratio, seconds_of, time_bin

STATS = {"mean": F.avg, "median": F.median, "std": F.stddev_samp, "count": F.count}


def by_cell(df: DataFrame, value: str = "vod", cell: str = "cell_id", stat: str = "mean", sids: Sequence[str] | None = None, start=None, end=None) -> DataFrame:
    """mean, median, std (sample) or count of a value per cell; optional signals and closed time range. Rows without cell don't count."""
    if stat not in STATS:
        raise ValueError(f"unknown statistic {stat!r}")
    if sids is not None:
        df = df.where(F.col("sid").isin(list(sids)))
    if start is not None:
        df = df.where(F.col("epoch") >= F.lit(start))
    if end is not None:
        df = df.where(F.col("epoch") <= F.lit(end))
    return df.where(F.col(cell).isNotNull()).groupBy(cell).agg(STATS[stat](value).alias("value"))


def on_grid(stats: DataFrame, grid: DataFrame, cell: str = "cell_id") -> DataFrame:
    """Per-cell statistics for every cell of a grid, null where there is none."""
    return grid.select("cell_id").join(stats.withColumnRenamed(cell, "cell_id"), "cell_id", "left")


def percell_timeseries(df: DataFrame, freq: str = "1D", value: str = "vod", cell: str = "cell_id", min_obs: int = 1) -> DataFrame:
    """Per cell and time bin: mean value, weight and count (of values); bins with fewer than ``min_obs`` are left out.

    One grouping over all time: bins are whole whatever the input's chunks.
    """
    known = df.where(F.col(cell).isNotNull() & F.col(value).isNotNull())
    out = known.groupBy(F.col(cell).alias("cell_id"), time_bin(F.col("epoch"), freq).alias("time"))
    out = out.agg(F.avg(value).alias("value"), F.count(value).alias("count")).where(F.col("count") >= min_obs)
    return out.withColumn("weight", F.col("count").cast("double"))


def dense(percell: DataFrame, grid: DataFrame, freq: str) -> DataFrame:
    """A row for every cell and bin between the first and last bin."""
    ends = percell.agg(F.min("time").alias("lo"), F.max("time").alias("hi"))
    step = F.expr(f"make_interval(0, 0, 0, 0, 0, 0, {seconds_of(freq)})")
    times = ends.where("lo is not null").select(F.explode(F.sequence("lo", "hi", step)).alias("time"))
    return grid.select("cell_id").join(times).join(percell, ["cell_id", "time"], "left")


def global_average(percell: DataFrame) -> DataFrame:
    """Per time: weighted mean (cells without value weigh nothing), population deviation over cells, weight and cells."""
    used = F.when(F.col("value").isNotNull(), F.col("weight"))
    return percell.groupBy("time").agg(
        ratio(F.sum(F.col("value") * F.col("weight")), F.sum("weight")).alias("mean"),
        F.stddev_pop("value").alias("spatial_std"),
        F.sum(used).alias("total_weight"),
        F.count("value").alias("n_cells"),
    )


def regional_average(percell: DataFrame, cells: DataFrame) -> DataFrame:
    """Weighted mean per time over the cells listed in ``cells`` (cell_id)."""
    inside = percell.join(cells.select("cell_id").distinct(), "cell_id", "left_semi")
    return inside.groupBy("time").agg(ratio(F.sum(F.col("value") * F.col("weight")), F.sum("weight")).alias("mean"), F.count("value").alias("n_cells"))


def diurnal_patterns(percell: DataFrame) -> DataFrame:
    return percell.groupBy("cell_id", F.hour("time").alias("hour")).agg(F.avg("value").alias("value"), F.avg("weight").alias("weight"))


def spatial_patterns(percell: DataFrame) -> DataFrame:
    return percell.groupBy("cell_id").agg(F.avg("value").alias("value"), F.avg("weight").alias("weight"))


def spatial_statistics(df: DataFrame, grid: DataFrame, value: str = "vod") -> DataFrame:
    """Per grid cell mean, sample deviation, count and median; null where nothing was observed."""
    stats = df.where(F.col("cell_id").isNotNull()).groupBy("cell_id").agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.count(value).alias("count"), F.median(value).alias("median"))
    return grid.select("cell_id").join(stats, "cell_id", "left")


def coverage_percent(stats: DataFrame) -> DataFrame:
    return stats.agg((100.0 * F.count("mean") / F.count(F.lit(1))).alias("coverage"), F.count("mean").alias("covered"), F.count(F.lit(1)).alias("cells"))


def histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """Counts in equal bins between the smallest and largest value, the last bin closed."""
    ends = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    at = F.floor((F.col(value) - F.col("lo")) / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0)) * bins)
    placed = df.where(F.col(value).isNotNull()).join(ends).select(F.least(F.lit(bins - 1), F.coalesce(at, F.lit(0))).cast("int").alias("bin"))
    return placed.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


def median_spacing(df: DataFrame, epoch: str = "epoch") -> float | None:
    """Median seconds between successive distinct epochs. Distinct epochs are shifted by sorting ranges, not by one window over all."""
    epochs = df.select(micros(F.col(epoch)).alias("t")).distinct()
    day = F.floor(F.col("t") / 86_400_000_000)
    inner = epochs.selectExpr("t", "t - lag(t) over (partition by floor(t / 86400000000D) order by t) as gap").where("gap is not null").select("gap")
    ends = epochs.groupBy(day.alias("d")).agg(F.min("t").alias("a"), F.max("t").alias("b"))
    between = ends.selectExpr("a - lag(b) over (order by d) as gap").where("gap is not null")  # one row a day
    found = inner.unionByName(between).agg(F.median("gap").alias("m")).first()["m"]
    return None if found is None else found / 1e6


def temporal_aggregate(df: DataFrame, freq: str = "1min", method: str = "mean", values: Sequence[str] = ("snr", "phi", "theta"), keys: Sequence[str] = ("receiver", "sid"), adaptive: bool = True) -> DataFrame:
    """Mean or median per bin and signal of every value (angles too, arithmetically).

    With ``adaptive`` the input comes back unchanged if its median epoch spacing
    is no finer than ``freq``.
    """
    if adaptive and (spacing := median_spacing(df)) is not None and spacing >= seconds_of(freq):
        return df
    use = {"mean": F.avg, "median": F.median}[method]
    return df.groupBy(*keys, time_bin(F.col("epoch"), freq).alias("epoch")).agg(*[use(v).alias(v) for v in values])


def resample_signals(df: DataFrame, freq: str = "1D", value: str = "vod") -> DataFrame:
    """Per signal and bin the mean of value and angles, without bins in which no signal has a value."""
    out = df.groupBy("sid", time_bin(F.col("epoch"), freq).alias("epoch")).agg(*[F.avg(c).alias(c) for c in (value, "phi", "theta")])
    filled = out.where(F.col(value).isNotNull()).select("epoch").distinct()
    return out.join(filled, "epoch", "left_semi")


def _weighted(value: Column, weight: Column) -> tuple[Column, Column]:
    """Weighted mean and weighted population deviation from sums of one pass."""
    w = F.sum(weight)
    mean = ratio(F.sum(weight * value), w)
    return mean, F.sqrt(F.greatest(ratio(F.sum(weight * value * value), w) - mean * mean, F.lit(0.0)))


def with_weights(df: DataFrame, weights: DataFrame | None, cells: int) -> DataFrame:
    """Adds ``w``: the cell's weight (0 for a cell without one), or the same share for all of ``cells``."""
    if weights is None:
        return df.withColumn("w", F.lit(1.0 / cells))
    return df.join(weights.select("cell_id", F.col("weight").alias("w")), "cell_id", "left").withColumn("w", F.coalesce("w", F.lit(0.0)))


def weighted_timeseries(df: DataFrame, freq: str = "1D", weights: DataFrame | None = None, cells: int = 1, min_cells: int = 1, value: str = "vod") -> DataFrame:
    """Per bin: weighted mean and population deviation, distinct cells, observations, weight; bins need ``min_cells`` and some weight."""
    known = with_weights(df.where(F.col("cell_id").isNotNull() & F.col(value).isNotNull()), weights, cells)
    mean, std = _weighted(F.col(value), F.col("w"))
    out = known.groupBy(time_bin(F.col("epoch"), freq).alias("time")).agg(
        mean.alias("mean"), std.alias("std"), F.countDistinct("cell_id").alias("n_cells"), F.count(value).alias("n_obs"), F.sum("w").alias("total_weight")
    )
    return out.where((F.col("n_cells") >= min_cells) & (F.col("total_weight") > 0))


def solar_corrected_timeseries(df: DataFrame, lat: float, lon: float, freq: str = "1D", weights: DataFrame | None = None, cells: int = 1, min_cells: int = 1, value: str = "vod", correction: str = "normalize", daytime: bool = True) -> DataFrame:
    """``weighted_timeseries`` of values corrected for the sun's height ("normalize" or "cosine"), of daytime only if asked."""
    if correction not in ("normalize", "cosine"):
        raise ValueError(f"unknown correction {correction!r}")
    sun = solar.position(F.col("epoch"), lat, lon)
    known = df.withColumn("zenith_", sun["zenith"])
    if daytime:
        known = known.where(solar.is_daytime(90 - F.col("zenith_")))
    use = solar.normalised if correction == "normalize" else solar.cosine_corrected
    return weighted_timeseries(known.withColumn(value, use(F.col(value), F.col("zenith_"))), freq, weights, cells, min_cells, value)


def hemisphere_percell(df: DataFrame, value: str = "vod") -> DataFrame:
    """Daily series of every cell."""
    return percell_timeseries(df, "1D", value)


def zenith_percell(df: DataFrame, grid: DataFrame, value: str = "vod") -> DataFrame:
    """Daily series of the cells whose centre lies within 30 degrees of the zenith."""
    near = grid.where(F.round(F.degrees("theta"), 9) <= 30).select("cell_id")
    return percell_timeseries(df.join(near, "cell_id", "left_semi"), "1D", value)


def _cycle(df: DataFrame, at: Column, bins: DataFrame, weights, cells, min_obs: int, value: str) -> DataFrame:
    known = with_weights(df.where(F.col("cell_id").isNotNull() & F.col(value).isNotNull()), weights, cells)
    mean, std = _weighted(F.col(value), F.col("w"))
    found = known.groupBy(at.alias("bin")).agg(mean.alias("mean"), std.alias("std"), F.count(value).alias("n_obs"))
    enough = F.col("n_obs") >= min_obs
    return bins.join(found, "bin", "left").select(
        "bin", F.when(enough, F.col("mean")).alias("mean"), F.when(enough, F.col("std")).alias("std"), F.when(enough, F.col("n_obs")).otherwise(0).alias("n_obs")
    )


def _bins(df: DataFrame, n: int) -> DataFrame:
    return df.sparkSession.range(n).select(F.col("id").cast("int").alias("bin"))


def diurnal_cycle(df: DataFrame, hour_bins: int = 24, min_observations: int = 10, weights: DataFrame | None = None, cells: int = 1, value: str = "vod") -> DataFrame:
    """Weighted cycle over right-closed bins of the hour (the first also holds 0); every bin gives a row."""
    hour = F.hour("epoch") + F.minute("epoch") / 60.0
    at = F.greatest(F.ceil(hour / (24.0 / hour_bins)) - 1, F.lit(0)).cast("int")
    return _cycle(df, at, _bins(df, hour_bins), weights, cells, min_observations, value)


def binned_cycle(df: DataFrame, bin_: Column, bins: int, min_observations: int = 10, weights: DataFrame | None = None, cells: int = 1, value: str = "vod") -> DataFrame:
    """The same over any bin number, such as one of solar elevation."""
    return _cycle(df, bin_, _bins(df, bins), weights, cells, min_observations, value)

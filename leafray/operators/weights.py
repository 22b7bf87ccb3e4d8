"""Cell weights (cell_id, weight)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafray.operators.grids import solid_angle
from leafray.operators.topology import voronoi


def area(grid: DataFrame, kind: str = "equal_area", cells: int | None = None) -> DataFrame:
    """Solid angles; those of the Voronoi cells for a Fibonacci grid."""
    if kind == "fibonacci":
        return voronoi(grid).select("cell_id", F.col("solid_angle").alias("weight"))
    return grid.select("cell_id", solid_angle(kind, cells).alias("weight"))


def sin_elevation(grid: DataFrame) -> DataFrame:
    return grid.select("cell_id", F.greatest(F.cos("theta"), F.lit(0.0)).alias("weight"))


def uniform(grid: DataFrame) -> DataFrame:
    return normalise(grid.select("cell_id", F.lit(1.0).alias("weight")))


def _for_grid(grid: DataFrame, found: DataFrame) -> DataFrame:
    return grid.select("cell_id").join(found, "cell_id", "left").select("cell_id", F.coalesce("weight", F.lit(0.0)).alias("weight"))


def observation_count(df: DataFrame, grid: DataFrame, value: str = "vod", min_count: int = 1) -> DataFrame:
    n = df.groupBy("cell_id").agg(F.count(value).alias("n"))
    return _for_grid(grid, n.select("cell_id", F.when(F.col("n") >= min_count, F.col("n").cast("double")).otherwise(0.0).alias("weight")))


def signal_strength(df: DataFrame, grid: DataFrame, snr: str = "snr", method: str = "mean") -> DataFrame:
    use = {"mean": F.avg, "median": F.median, "max": F.max}[method]
    return _for_grid(grid, df.groupBy("cell_id").agg(use(snr).cast("double").alias("weight")))


def inverse_variance(df: DataFrame, grid: DataFrame, value: str = "vod", min_observations: int = 2, regularization: float = 0.0) -> DataFrame:
    """1 / (sample variance + regularization); 0 with too few values or no variance."""
    v = df.groupBy("cell_id").agg(F.var_samp(value).alias("v"), F.count(value).alias("n"))
    ok = (F.col("n") >= min_observations) & (F.col("v") > 0)
    return _for_grid(grid, v.select("cell_id", F.when(ok, 1.0 / (F.col("v") + regularization)).otherwise(0.0).alias("weight")))


def normalise(weights: DataFrame) -> DataFrame:
    """Weights that sum to 1; the same for all where the sum is 0."""
    total = weights.agg(F.sum("weight").alias("total"), F.count(F.lit(1)).alias("cells"))
    share = F.when(F.col("total") > 0, F.coalesce("weight", F.lit(0.0)) / F.nullif("total", F.lit(0.0))).otherwise(F.lit(1.0) / F.col("cells"))
    return weights.join(F.broadcast(total)).select("cell_id", share.alias("weight"))  # one row


def combine(parts: Sequence[DataFrame], mode: str = "multiply", normalised: bool = True) -> DataFrame:
    """Product or sum of component weights; a missing component counts as 0."""
    if mode not in ("multiply", "add"):
        raise ValueError(f"unknown mode {mode!r}")
    named = [p.select("cell_id", F.col("weight").alias(f"w{i}")) for i, p in enumerate(parts)]
    joined = reduce(lambda a, b: a.join(b, "cell_id", "full"), named)
    values = [F.coalesce(f"w{i}", F.lit(0.0)) for i in range(len(parts))]
    out = joined.select("cell_id", reduce(lambda a, b: a * b if mode == "multiply" else a + b, values).alias("weight"))
    return normalise(out) if normalised else out

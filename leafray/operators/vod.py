"""Vegetation optical depth from a receiver below the canopy and one under open sky."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafray.functions.columns import finite_columns

KEYS = ("epoch", "sid")


def optical_depth(delta_db: Column, theta: Column) -> Column:
    """-ln(transmissivity) cos(theta), where the transmissivity is the dB difference made linear; null if that isn't positive."""
    linear = F.pow(F.lit(10.0), delta_db / 10)
    return -F.ln(F.when(linear > 0, linear)) * F.cos(theta)


def tau_omega(canopy: DataFrame, sky: DataFrame, keys: Sequence[str] = KEYS, radial_difference: bool = False) -> DataFrame:
    """Inner join of both receivers on epoch and signal: keys, phi, theta, delta_snr, vod (and r_diff).

    Angles are the canopy receiver's. NaN and infinite values count as missing.
    """
    names = ["snr", "theta", *(["r"] if radial_difference else [])]
    own = finite_columns(canopy, *names)
    other = finite_columns(sky, *[n for n in names if n != "theta"]).select(*keys, *[F.col(n).alias(f"sky_{n}") for n in names if n != "theta"])
    delta = F.col("snr") - F.col("sky_snr")
    out = own.join(other, list(keys)).withColumn("delta_snr", delta).withColumn("vod", optical_depth(delta, F.col("theta")))
    extra = [(F.col("r") - F.col("sky_r")).alias("r_diff")] if radial_difference else []
    return out.select(*keys, "phi", "theta", "delta_snr", "vod", *extra)


def pairs(receivers: DataFrame) -> DataFrame:
    """Analysis pairs of (canopy, references array): one row per canopy and reference."""
    return receivers.select("canopy", F.explode("references").alias("reference")).distinct()


def daily_summary(vod: DataFrame) -> DataFrame:
    """Mean, population deviation and epochs of each day."""
    return vod.groupBy(F.to_date("epoch").alias("day")).agg(F.avg("vod").alias("mean_vod"), F.stddev_pop("vod").alias("std_vod"), F.countDistinct("epoch").alias("n_epochs"))

"""Sun position by the public NOAA equations, and corrections for it."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafray.functions.columns import micros


def position(ts: Column, lat: float, lon: float) -> dict[str, Column]:
    """Zenith, azimuth and elevation of the sun in degrees at a site.

    The azimuth is the angle from north without its side, 0 to 180, as it
    follows from the sides of the triangle between pole, zenith and sun; where
    the hour angle is exactly 0 it is counted down from 360. In the zenith it is
    null.
    """
    rad, deg, sin, cos = F.radians, F.degrees, F.sin, F.cos
    whole = (F.floor(micros(ts) / 1_000_000) * 1.0).cast("double")
    day = whole / 86400.0 + 2440587.5
    jc = (day - 2451545.0) / 36525.0
    mean_long = F.pmod(280.46646 + jc * (36000.76983 + jc * 0.0003032), F.lit(360.0))
    anomaly = 357.52911 + jc * (35999.05029 - 0.0001537 * jc)
    ecc = 0.016708634 - jc * (0.000042037 + 0.0000001267 * jc)
    centre = sin(rad(anomaly)) * (1.914602 - jc * (0.004817 + 0.000014 * jc)) + sin(rad(2 * anomaly)) * (0.019993 - 0.000101 * jc) + sin(rad(3 * anomaly)) * 0.000289
    node = rad(125.04 - 1934.136 * jc)
    apparent = mean_long + centre - 0.00569 - 0.00478 * sin(node)
    tilt = 23 + (26 + (21.448 - jc * (46.815 + jc * (0.00059 - jc * 0.001813))) / 60) / 60 + 0.00256 * cos(node)
    decl = F.asin(sin(rad(tilt)) * sin(rad(apparent)))
    y = F.pow(F.tan(rad(tilt / 2)), 2)
    two_l, m = 2 * rad(mean_long), rad(anomaly)
    time = 4 * deg(y * sin(two_l) - 2 * ecc * sin(m) + 4 * ecc * y * sin(m) * cos(two_l) - 0.5 * y * y * sin(2 * two_l) - 1.25 * ecc * ecc * sin(2 * m))
    minutes = F.pmod(whole, F.lit(86400.0)) / 60.0
    solar = F.pmod(minutes + time + 4 * lon, F.lit(1440.0))
    angle = rad(F.pmod(solar / 4 + 180, F.lit(360.0)))
    sl, cl = math.sin(math.radians(lat)), math.cos(math.radians(lat))
    height = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), sl * sin(decl) + cl * cos(decl) * cos(angle)))
    across, along = cl * cos(decl) * F.abs(sin(angle)), sl * height - sin(decl)
    side = F.when((across != 0) | (along != 0), deg(F.atan2(across, along)))
    return {"zenith": deg(F.acos(height)), "azimuth": F.when(angle == 0, 360 - side).otherwise(side), "elevation": 90 - deg(F.acos(height))}


def sunrise_sunset(days: DataFrame, lat: float, lon: float, day: str = "day") -> DataFrame:
    """Per distinct day the first and last minute with the sun above the horizon; null where it doesn't rise."""
    start = F.col(day).cast("timestamp_ntz")
    minute = F.explode(F.sequence(start, start + F.expr("interval 23 hour 59 minute"), F.expr("interval 1 minute")))
    up = days.select(day).distinct().withColumn("t_", minute).withColumn("up_", position(F.col("t_"), lat, lon)["elevation"] > 0)
    seen = F.when(F.col("up_"), F.col("t_"))
    return up.groupBy(day).agg(F.min(seen).alias("sunrise"), F.max(seen).alias("sunset"))


def normalised(value: Column, zenith: Column, reference: float = 45.0) -> Column:
    """Scaled by cos(reference) / cos(zenith), the factor held between 0.5 and 2."""
    c = F.cos(F.radians(zenith))
    factor = math.cos(math.radians(reference)) / F.when(c != 0, c)
    return value * F.least(F.lit(2.0), F.greatest(F.lit(0.5), F.coalesce(factor, F.lit(2.0))))


def cosine_corrected(value: Column, zenith: Column) -> Column:
    """Divided by cos(zenith), held between 0.1 and 1."""
    return value / F.least(F.lit(1.0), F.greatest(F.lit(0.1), F.cos(F.radians(zenith))))


def is_daytime(elevation: Column, twilight: float = -6.0) -> Column:
    return elevation > twilight


def solar_bin(elevation: Column, bins: int = 12, low: float = -20.0, high: float = 90.0) -> Column:
    """Left-closed bins of elevation, the outer ones taking what lies beyond."""
    at = F.floor((elevation - low) / ((high - low) / bins))
    return F.least(F.lit(bins - 1), F.greatest(F.lit(0), at)).cast("int")

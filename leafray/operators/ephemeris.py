"""Satellite directions for observations: from orbit and clock products, or as the receiver reported them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafray.functions import geometry
from leafray.operators import interpolate


def augment(obs: DataFrame, orbits: DataFrame, receiver: tuple[float, float, float], clocks: DataFrame | None = None, key: str = "sv", jump: float = 1e-6) -> DataFrame:
    """``obs`` (key, epoch, ...) with r, theta and phi of its satellite seen from an ECEF ``receiver``, and the satellite's clock.

    Positions come from ``orbits`` (key, epoch, x, y, z) by Hermite pieces, with
    velocities from differences where the product has none; ``clocks`` (key,
    epoch, clock) are taken within their segments. Each pair of satellite and
    epoch is worked out once, however many signals were observed. Observations
    of a satellite without product, or below the horizon, keep nulls.
    """
    if "vx" not in orbits.columns:
        orbits = interpolate.velocities(orbits, key)
    wanted = obs.select(key, "epoch").distinct()
    at = interpolate.positions(orbits, wanted, key)
    seen = at.select(key, "epoch", *[c.alias(n) for n, c in geometry.direction(F.col("x"), F.col("y"), F.col("z"), receiver).items()])
    if clocks is not None:
        seen = seen.join(interpolate.clocks(clocks, wanted, key, jump), [key, "epoch"], "left")
    return obs.drop("r", "theta", "phi", "clock").join(seen, [key, "epoch"], "left")


def augment_reported(obs: DataFrame, reported: DataFrame) -> DataFrame:
    """``obs`` with theta and phi that the receiver reported for the same epoch and signal; null where it reported none."""
    return obs.drop("theta", "phi").join(reported.select("epoch", "sid", "theta", "phi"), ["epoch", "sid"], "left")


def chain(df: DataFrame, steps: Sequence[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """The steps of an augmentation, one after the other."""
    return reduce(lambda d, step: d.transform(step), steps, df)

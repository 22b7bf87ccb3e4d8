"""Selections of grid cells."""

from __future__ import annotations

import math
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafray.functions.columns import in_azimuth_range

HEMISPHERES = {"north": (315, 45), "east": (45, 135), "south": (135, 225), "west": (225, 315)}


def azimuth(low: float, high: float, degrees: bool = False) -> Column:
    k = math.pi / 180 if degrees else 1.0
    return in_azimuth_range(F.col("phi"), low * k, high * k)


def polar(low: float, high: float, degrees: bool = False) -> Column:
    k = math.pi / 180 if degrees else 1.0
    return F.col("theta").between(low * k, high * k)


def elevation(low: float, high: float) -> Column:
    """Degrees above the horizon."""
    return F.round(90 - F.degrees("theta"), 9).between(low, high)


def sector(centre: float, width: float, theta_low: float = 0.0, theta_high: float = math.pi / 2) -> Column:
    """Degrees of azimuth about a centre, radians of theta."""
    return azimuth(centre - width / 2, centre + width / 2, degrees=True) & polar(theta_low, theta_high)


def hemisphere(name: str) -> Column:
    return azimuth(*HEMISPHERES[name], degrees=True)


def cells(ids: Iterable[int]) -> Column:
    return F.col("cell_id").isin(list(ids))


def threshold(column: str, low: float | None = None, high: float | None = None) -> Column:
    tests = [F.col(column) >= low] if low is not None else []
    tests += [F.col(column) <= high] if high is not None else []
    return F.coalesce(reduce(lambda a, b: a & b, tests, F.col(column).isNotNull()), F.lit(False))


def boundary(grid: DataFrame) -> DataFrame:
    """Cells of the outermost ring (largest theta_max)."""
    return grid.join(grid.agg(F.max("theta_max").alias("edge")), F.abs(F.col("theta_max") - F.col("edge")) < 1e-9, "left_semi").select("cell_id")


def combine(masks: list[Column], mode: str = "AND") -> Column:
    if not masks:
        raise ValueError("no masks to combine")
    if mode not in ("AND", "OR"):
        raise ValueError(f"unknown mode {mode!r}")
    return reduce(lambda a, b: a & b if mode == "AND" else a | b, masks)


def select(grid: DataFrame, mask: Column) -> DataFrame:
    return grid.where(mask).select("cell_id")

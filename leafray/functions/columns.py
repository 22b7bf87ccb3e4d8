"""Small column helpers: missing values, time bins, angles."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TWO_PI = 2 * math.pi
_UNITS = {"s": 1, "min": 60, "t": 60, "h": 3600, "d": 86400}


def finite(value: Column) -> Column:
    """The value, or null where it is NaN or infinite."""
    return F.when(~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))), value)


def finite_columns(df: DataFrame, *names: str) -> DataFrame:
    """``df`` with NaN and infinities of the named columns as null: null is the only missing value downstream."""
    return df.withColumns({n: finite(F.col(n)) for n in names})


def seconds_of(freq: str) -> int:
    """Seconds of a frequency such as 30s, 5min, 15T, 1H or 1D."""
    m = re.fullmatch(r"\s*(\d*)\s*([A-Za-z]+)\s*", freq)
    unit = {"minutes": "min", "m": "min", "hours": "h", "days": "d", "sec": "s"}.get(m[2].lower(), m[2].lower()) if m else ""
    if unit not in _UNITS:
        raise ValueError(f"unknown frequency {freq!r}")
    return int(m[1] or 1) * _UNITS[unit]


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def time_bin(ts: Column, freq: str) -> Column:
    """Start of the bin of width ``freq`` that holds ``ts`` (bins count from the epoch; up to one day)."""
    width = seconds_of(freq) * 1_000_000
    return F.timestamp_micros((F.floor(micros(ts) / width) * width).cast("long")).cast("timestamp_ntz")


def without_keys(attrs: Column, drop: list[str]) -> Column:
    """A map of attributes without the named keys and without missing values."""
    return F.map_filter(attrs, lambda k, v: ~k.isin(drop) & v.isNotNull())


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts) + F.minute(ts) / 60.0


def wrap(angle: Column, full: float = TWO_PI) -> Column:
    return F.pmod(angle, F.lit(full))


def in_azimuth_range(phi: Column, low: float, high: float) -> Column:
    """Azimuth (radians) between two bounds taken modulo a full turn; a lower bound above the upper wraps over north."""
    lo, hi, p = low % TWO_PI, high % TWO_PI, wrap(phi)
    return (p >= lo) & (p <= hi) if lo <= hi else (p >= lo) | (p <= hi)


def wrapped_difference(a: Column, b: Column) -> Column:
    """a - b in degrees, brought to (-180, 180]."""
    d = a - b
    return F.when(d > 180, d - 360).when(d <= -180, d + 360).otherwise(d)


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0."""
    return a / F.when(b != 0, b)

"""WGS-84 positions and satellite directions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafray.functions.columns import TWO_PI

# Fixed values of the WGS-84 ellipsoid: semi-major axis in metres, flattening.
A, FLATTENING = 6378137.0, 1 / 298.257223563
E2 = FLATTENING * (2 - FLATTENING)


def geodetic_to_ecef(lat: float, lon: float, height: float) -> tuple[float, float, float]:
    p, l = math.radians(lat), math.radians(lon)
    n = A / math.sqrt(1 - E2 * math.sin(p) ** 2)
    return (n + height) * math.cos(p) * math.cos(l), (n + height) * math.cos(p) * math.sin(l), (n * (1 - E2) + height) * math.sin(p)


def ecef_to_geodetic(x: float, y: float, z: float) -> tuple[float, float, float]:
    """Latitude and longitude in degrees, height in metres; iterated to the limit of doubles."""
    lon, flat = math.atan2(y, x), math.hypot(x, y)
    lat = math.atan2(z, flat * (1 - E2))
    for _ in range(12):
        n = A / math.sqrt(1 - E2 * math.sin(lat) ** 2)
        lat = math.atan2(z + E2 * n * math.sin(lat), flat)
    n = A / math.sqrt(1 - E2 * math.sin(lat) ** 2)
    height = flat * math.cos(lat) + z * math.sin(lat) - A * math.sqrt(1 - E2 * math.sin(lat) ** 2)
    return math.degrees(lat), math.degrees(lon), height


def ecef_columns(lat: Column, lon: Column, height: Column) -> dict[str, Column]:
    p, l = F.radians(lat), F.radians(lon)
    n = F.lit(A) / F.sqrt(1 - E2 * F.sin(p) * F.sin(p))
    return {"x": (n + height) * F.cos(p) * F.cos(l), "y": (n + height) * F.cos(p) * F.sin(l), "z": (n * (1 - E2) + height) * F.sin(p)}


def direction(x: Column, y: Column, z: Column, receiver: tuple[float, float, float]) -> dict[str, Column]:
    """Range, polar angle from zenith and azimuth from north of satellites seen from an ECEF receiver.

    All three are null below the horizon and where range is 0; rows stay.
    """
    lat, lon, _ = ecef_to_geodetic(*receiver)
    sp, cp, sl, cl = (f(math.radians(v)) for v, f in ((lat, math.sin), (lat, math.cos), (lon, math.sin), (lon, math.cos)))
    dx, dy, dz = x - receiver[0], y - receiver[1], z - receiver[2]
    east = dy * cl - dx * sl
    north = dz * cp - dx * (sp * cl) - dy * (sp * sl)
    up = dx * (cp * cl) + dy * (cp * sl) + dz * sp
    r = F.sqrt(dx * dx + dy * dy + dz * dz)
    seen = (up >= 0) & (r > 0)
    cosine = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), up / F.when(r > 0, r)))
    return {"r": F.when(seen, r), "theta": F.when(seen, F.acos(cosine)), "phi": F.when(seen, F.pmod(F.atan2(east, north), F.lit(TWO_PI)))}

"""Outlier filters: a mask and a filtered column beside the original, over all rows or within cells.

A mask is true where a value stays; missing values have a false mask. Within
cells, groups that are too small, or have no spread, keep all their values.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafray.operators.ordered import exact_quantiles


class Filter:
    """Statistics that a filter needs, and the mask made of them (columns ``s0``, ``s1``, ...)."""

    name = "filter"
    least = 1
    #: Set where the statistics are these quantiles.
    quantiles: Sequence[float] = ()

    def statistics(self, value: Column) -> list[Column]:
        return [F.percentile(value, F.lit(p)) for p in self.quantiles]

    def mask(self, value: Column, stats: list[Column]) -> Column:
        raise NotImplementedError

    def spread(self, stats: list[Column]) -> Column:
        return F.lit(True)


class ZScore(Filter):
    """At most ``threshold`` population deviations from the mean."""

    name, least = "zscore", 3

    def __init__(self, threshold: float = 3.0):
        self.threshold = threshold

    def statistics(self, value):
        return [F.avg(value), F.stddev_pop(value)]

    def mask(self, value, stats):
        return F.abs(value - stats[0]) <= self.threshold * stats[1]

    def spread(self, stats):
        return stats[1] > 0


class Iqr(Filter):
    """Within ``factor`` interquartile ranges of the quartiles (linear quantiles)."""

    name, least, quantiles = "iqr", 4, (0.25, 0.75)

    def __init__(self, factor: float = 1.5):
        self.factor = factor

    def mask(self, value, stats):
        span = (stats[1] - stats[0]) * self.factor
        return (value >= stats[0] - span) & (value <= stats[1] + span)

    def spread(self, stats):
        return stats[1] > stats[0]


class Percentile(Filter):
    name, least = "percentile", 5

    def __init__(self, lower: float = 5.0, upper: float = 95.0):
        self.quantiles = lower / 100, upper / 100

    def mask(self, value, stats):
        return (value >= stats[0]) & (value <= stats[1])


class Range(Filter):
    """Closed bounds, each optional; without any, every value stays."""

    name, least = "range", 0

    def __init__(self, low: float | None = None, high: float | None = None):
        self.low, self.high = low, high

    def mask(self, value, stats):
        tests = [value >= self.low] if self.low is not None else []
        tests += [value <= self.high] if self.high is not None else []
        return reduce(lambda a, b: a & b, tests, F.lit(True))


class Custom(Filter):
    name, least = "custom", 0

    def __init__(self, test: Callable[[Column], Column]):
        self.test = test

    def mask(self, value, stats):
        return self.test(value)


def apply(df: DataFrame, filter_: Filter, value: str = "vod", by: Sequence[str] = (), min_observations: int = 5, suffix: str | None = None) -> DataFrame:
    """Adds ``mask_<suffix>`` and ``<value>_filtered_<suffix>``.

    Without ``by`` the statistics are those of all rows: one row, joined to all;
    quantiles take two passes, so that no task holds all values. With ``by``
    they are those of each group; partial aggregation makes a group of any size
    one row before the shuffle, except for exact quantiles, whose distinct
    values are counted.
    """
    suffix = suffix or filter_.name
    v = F.col(value)
    made = filter_.statistics(v)
    if filter_.quantiles and not by:
        stats = exact_quantiles(df, v, filter_.quantiles)
        df = df.join(F.broadcast(stats.select(*[F.get("q", F.lit(i)).alias(f"s{i}_") for i in range(len(made))])), how="left")  # one row
    elif made or by:
        stats = df.groupBy(*by).agg(F.count(v).alias("n_"), *[c.alias(f"s{i}_") for i, c in enumerate(made)])
        if by:
            stats = stats.withColumnsRenamed({b: f"{b}_" for b in by})
            same = reduce(lambda a, b: a & b, [F.col(b).eqNullSafe(F.col(f"{b}_")) for b in by])
            df = df.join(stats, same, "left").drop(*[f"{b}_" for b in by])
        else:
            df = df.join(F.broadcast(stats))  # one row
    cols = [F.col(f"s{i}_") for i in range(len(made))]
    test = filter_.mask(v, cols)
    if by:
        small = F.col("n_") < max(min_observations, filter_.least)
        test = F.when(small | ~F.coalesce(filter_.spread(cols), F.lit(False)), F.lit(True)).otherwise(test)
    mask = F.coalesce(test, F.lit(False)) & v.isNotNull()
    out = df.withColumn(f"mask_{suffix}", mask).withColumn(f"{value}_filtered_{suffix}", F.when(mask, v))
    return out.drop("n_", *[f"s{i}_" for i in range(len(made))])


def pipeline(df: DataFrame, filters: Sequence[Filter], value: str = "vod", by: Sequence[str] = (), mode: str = "sequential", name: str = "pipeline", min_observations: int = 5) -> DataFrame:
    """Several filters on one value, and the value that all keep, as ``<value>_filtered_<name>``.

    Over all rows each mask is taken on the original value, in both modes, so
    they differ in names only. Within cells, "sequential" gives each filter
    what the one before it left; "combined" gives all of them the original.
    """
    if mode not in ("sequential", "combined"):
        raise ValueError(f"unknown mode {mode!r}")
    current, masks = value, []
    for i, f in enumerate(filters):
        suffix = f"{f.name}{i}"
        df = apply(df, f, current, by, min_observations, suffix)
        masks.append(F.col(f"mask_{suffix}"))
        if by and mode == "sequential":
            current = f"{current}_filtered_{suffix}"
    kept = reduce(lambda a, b: a & b, masks, F.lit(True))
    return df.withColumn(f"mask_{name}", kept).withColumn(f"{value}_filtered_{name}", F.when(kept, F.col(value)))


def removed(df: DataFrame, mask: str) -> DataFrame:
    """How many rows a mask removes, missing values included."""
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_if(~F.col(mask)).alias("removed"))


def signal_pattern(system: str | None = None, band: str | None = None, code: str | None = None, sid: str = "sid") -> Column:
    """Signals of a system, band and code; malformed identifiers never match."""
    parts = F.split(F.col(sid), r"\|")
    test = F.size(parts) == 3
    if system is not None:
        test = test & parts.getItem(0).startswith(system)
    if band is not None:
        test = test & (parts.getItem(1) == band)
    if code is not None:
        test = test & (parts.getItem(2) == code)
    return F.coalesce(test, F.lit(False))


def drop_empty_signals(df: DataFrame, values: Sequence[str]) -> DataFrame:
    """Without the signals that have no value in any variable."""
    some = reduce(lambda a, b: a | b, [F.col(v).isNotNull() for v in values])
    return df.join(df.where(some).select("sid").distinct(), "sid", "left_semi")


def ingest_checks(df: DataFrame) -> DataFrame:
    """Per receiver: rows, ranges and whether SNR, theta and phi are plausible."""
    pi = 3.141592653589793
    out = df.groupBy("receiver").agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{f.__name__}_{c}") for c in ("snr", "theta", "phi") for f in (F.min, F.max)])
    ok = (F.col("n") > 0) & (F.col("min_snr") >= 0) & (F.col("max_snr") <= 70)
    ok = ok & (F.col("min_theta") >= -0.01) & (F.col("max_theta") <= pi / 2 + 0.01) & (F.col("min_phi") >= -0.01) & (F.col("max_phi") <= 2 * pi + 0.01)
    return out.withColumn("valid", F.coalesce(ok, F.lit(False)))

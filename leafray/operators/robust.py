"""Hampel filters: global per group, sliding in time, on time bins, and one-step sigma clipping."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafray.functions.columns import micros, time_bin

SCALE = 1.4826
GROUP = ("cell_id", "sid")


def _with_mad(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Adds the group's count, median and raw median deviation; two grouped passes, no window over a whole group."""
    medians = df.groupBy(*by).agg(F.count(value).alias("n_"), F.median(value).alias("med_"))
    known = df.join(medians, list(by), "left")
    mads = known.groupBy(*by).agg(F.median(F.abs(F.col(value) - F.col("med_"))).alias("mad_"))
    return known.join(mads, list(by), "left")


def hampel(df: DataFrame, value: str = "vod", by: Sequence[str] = GROUP, threshold: float = 3.0, min_obs: int = 20, scale: float = 1.0, need_spread: bool = True) -> DataFrame:
    """Adds is_outlier, is_processed and ``<value>_filtered``.

    Outliers lie strictly more than ``threshold`` scaled median deviations from
    their group's median. Groups with fewer than ``min_obs`` values, or without
    deviation if ``need_spread``, are not processed and keep all values. Rows
    with a null key are kept unprocessed.
    """
    known = _with_mad(df, value, by)
    ready = F.coalesce((F.col("n_") >= min_obs) & ((F.col("mad_") > 0) if need_spread else F.col("mad_").isNotNull()), F.lit(False)) & F.col(value).isNotNull()
    out = ready & (F.abs(F.col(value) - F.col("med_")) > threshold * scale * F.col("mad_"))
    known = known.withColumn("is_processed", ready).withColumn("is_outlier", F.coalesce(out, F.lit(False)))
    return known.withColumn(f"{value}_filtered", F.when(~F.col("is_outlier"), F.col(value))).drop("n_", "med_", "mad_")


def sigma_clip(df: DataFrame, value: str = "vod", by: Sequence[str] = GROUP, threshold: float = 3.0, min_points: int = 5) -> DataFrame:
    """One clipping step about the median in units of the scaled median deviation; without deviation anything off the median goes."""
    return hampel(df, value, by, threshold, min_points, SCALE, need_spread=False)


def hampel_on_bins(df: DataFrame, freq: str = "1h", method: str = "mean", value: str = "vod", by: Sequence[str] = GROUP, threshold: float = 3.0, min_obs: int = 20) -> DataFrame:
    """Mean or median per bin and group, then the global filter on the bins; the filtered column does leave outliers out."""
    use = {"mean": F.avg, "median": F.median}[method]
    binned = df.groupBy(*by, time_bin(F.col("epoch"), freq).alias("epoch")).agg(use(value).alias(value), F.avg("phi").alias("phi"), F.avg("theta").alias("theta"))
    return hampel(binned, value, by, threshold, min_obs)


def _rank(values: list[float], split: int, middle: float, k: int) -> float:
    """The k-th smallest (from 0) distance to ``middle`` in sorted ``values``, of which ``split`` lie below it.

    Distances grow away from the split on both sides, so the k + 1 nearest are
    a run about it; bisection finds how many of them lie below.
    """
    low, high = max(0, k + 1 - (len(values) - split)), min(split, k + 1)
    while low < high:
        take = (low + high) // 2
        # one more from below is nearer than the last one taken from above
        if middle - values[split - take - 1] < values[split + k - take] - middle:
            low = take + 1
        else:
            high = take
    left = middle - values[split - low] if low else 0.0
    right = values[split + k - low] - middle if k + 1 > low else 0.0
    return max(left, right)


def _sliding(times: list[int], values: list[float | None], reach: int, threshold: float, min_points: int) -> list[bool]:
    """Which values, in order of time, are outliers of their frame; the frame is kept as a sorted list."""
    frame: list[float] = []
    first, last, out = 0, 0, []
    for t, v in zip(times, values, strict=True):
        while last < len(times) and times[last] <= t + reach:
            if values[last] is not None:
                insort(frame, values[last])
            last += 1
        while times[first] < t - reach:
            if values[first] is not None:
                del frame[bisect_left(frame, values[first])]
            first += 1
        n, found = len(frame), False
        if v is not None and n >= min_points:
            low, high = (n - 1) // 2, n // 2
            middle = (frame[low] + frame[high]) / 2
            split = bisect_left(frame, middle)
            mad = (_rank(frame, split, middle, low) + _rank(frame, split, middle, high)) / 2
            found = mad > 0 and abs(v - middle) > threshold * SCALE * mad
        out.append(found)
    return out


def sliding_hampel(df: DataFrame, hours: float = 1.0, value: str = "vod", by: Sequence[str] = GROUP, time: str = "epoch", threshold: float = 3.0, min_points: int = 5) -> DataFrame:
    """Adds is_outlier and ``<value>_filtered``: outliers of the closed frame of plus and minus ``hours`` around each value.

    Frames with fewer than ``min_points`` values, or without deviation, flag
    nothing. The group also goes by day parts of the time axis: each row is
    copied to the parts its frame reaches, so that one group with most of the
    rows still spreads over tasks. A part is swept once, in Arrow batches. Rows
    with a null key or time are in no frame and stay unflagged.
    """
    placed = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*by, time)])
    apart = df.where(~placed).withColumn("is_outlier", F.lit(False))
    df = df.where(placed)
    reach = int(hours * 3600 * 1_000_000)
    part = max(reach, 86_400_000_000)
    t = df.withColumn("t_", micros(F.col(time))).withColumn("home_", F.floor(F.col("t_") / part)).withColumn("v_", F.col(value).cast("double"))
    spots = F.array_distinct(F.array(*[F.floor((F.col("t_") + d) / part) for d in (-reach, 0, reach)]))
    own = F.struct(*df.columns)
    spread = t.select(*[F.col(b).alias(f"b{i}_") for i, b in enumerate(by)], F.explode(spots).alias("part_"), "t_", "home_", "v_", own.alias("row_"))
    # neighbours' rows only lend their values
    spread = spread.withColumn("row_", F.when(F.col("part_") == F.col("home_"), F.col("row_")))
    keys = [f"b{i}_" for i in range(len(by))] + ["part_"]
    kind = T.StructType([T.StructField("row_", spread.schema["row_"].dataType), T.StructField("is_outlier", T.BooleanType())])

    def sweep(table: pa.Table) -> pa.Table:
        table = table.sort_by("t_")
        found = _sliding(table["t_"].to_pylist(), table["v_"].to_pylist(), reach, threshold, min_points)
        return pa.table({"row_": table["row_"], "is_outlier": pa.array(found, pa.bool_())}).filter(table["row_"].is_valid())

    seen = spread.groupBy(*keys).applyInArrow(sweep, kind).select("row_.*", "is_outlier").unionByName(apart)
    return seen.withColumn(f"{value}_filtered", F.when(~F.col("is_outlier"), F.col(value)))

"""Signal dimensions and joins on them: bands, overlap groups, padding, satellite to signal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# System, band, centre frequency and bandwidth in MHz, tracking codes.
BANDS = [
    ("G", "L1", 1575.42, 30.69, "CSLXPWYMN"),
    ("G", "L2", 1227.60, 30.69, "CDSLXPWYMN"),
    ("G", "L5", 1176.45, 24.0, "IQX"),
    ("E", "E1", 1575.42, 24.552, "ABCXZ"),
    ("E", "E5a", 1176.45, 20.46, "IQX"),
    ("E", "E5b", 1207.14, 20.46, "IQX"),
    ("E", "E5", 1191.795, 51.15, "IQX"),
    ("E", "E6", 1278.75, 40.92, "ABCXZ"),
    ("R", "G1", 1602.0, 16.0, "CP"),
    ("R", "G2", 1246.0, 12.0, "CP"),
    ("R", "G3", 1202.025, 20.0, "IQX"),
    ("C", "B1I", 1561.098, 4.092, "IQX"),
    ("C", "B1C", 1575.42, 32.736, "DPX"),
    ("C", "B2a", 1176.45, 20.46, "DPX"),
    ("C", "B2b", 1207.14, 20.46, "IQXDPZ"),
    ("C", "B3I", 1268.52, 20.46, "IQX"),
    ("J", "L1", 1575.42, 24.0, "CSLXZB"),
    ("J", "L2", 1227.60, 24.0, "SLX"),
    ("J", "L5", 1176.45, 24.9, "IQXDPZ"),
    ("J", "L6", 1278.75, 39.0, "SLXEZ"),
    ("S", "L1", 1575.42, 30.69, "C"),
    ("S", "L5", 1176.45, 24.0, "IQX"),
    ("I", "L5", 1176.45, 24.0, "ABCX"),
    ("I", "S", 2492.028, 16.5, "ABCX"),
]
# Satellites of a system are numbered from 1 to this.
SATELLITES = {"G": 32, "E": 36, "R": 24, "C": 63, "J": 10, "S": 36, "I": 14}
# First and last number, system, and what is subtracted to get the satellite's own number.
NUMBER_RANGES = [
    (1, 37, "G", 0),
    (38, 61, "R", 37),
    (62, 62, "R", 62),
    (63, 68, "R", 38),
    (71, 106, "E", 70),
    (107, 119, "L", 0),
    (120, 140, "S", 0),
    (141, 180, "C", 140),
    (181, 187, "J", 180),
    (191, 197, "I", 190),
    (198, 215, "S", 57),
    (216, 222, "I", 208),
    (223, 245, "C", 182),
]


def bands(spark: SparkSession) -> DataFrame:
    """system, band, centre, low and high (MHz), codes."""
    d = spark.createDataFrame(BANDS, "system string, band string, freq_center double, width double, codes string")
    half = F.col("width") / 2
    return d.select("system", "band", "freq_center", (F.col("freq_center") - half).alias("freq_min"), (F.col("freq_center") + half).alias("freq_max"), F.filter(F.split("codes", ""), lambda c: c != "").alias("codes"))


def overlap_groups(spark: SparkSession) -> DataFrame:
    """Bands whose frequency ranges overlap, directly or over others: band, overlap_group, numbered by frequency.

    A sweep over the ranges in order: a group begins where a range starts above
    the highest end so far. Bands are a fixed dimension of a few rows.
    """
    b = bands(spark).groupBy("band").agg(F.min("freq_min").alias("freq_min"), F.max("freq_max").alias("freq_max"))
    w = Window.orderBy("freq_min", "band")
    top = F.max("freq_max").over(w.rowsBetween(Window.unboundedPreceding, -1))
    b = b.withColumn("new", F.coalesce(F.col("freq_min") > top, F.lit(True)).cast("int"))
    return b.select("band", F.concat(F.lit("group_"), F.sum("new").over(w)).alias("overlap_group"))


def universe(spark: SparkSession) -> DataFrame:
    """Every signal: sid, sv, system, band, code and frequencies."""
    n = spark.createDataFrame(list(SATELLITES.items()), "system string, satellites int")
    d = bands(spark).join(n, "system").withColumn("code", F.explode("codes")).withColumn("prn", F.explode(F.sequence(F.lit(1), F.col("satellites"))))
    sv = F.concat("system", F.lpad(F.col("prn").cast("string"), 2, "0"))
    return d.select(F.concat_ws("|", sv, "band", "code").alias("sid"), sv.alias("sv"), "system", "band", "code", "freq_center", "freq_min", "freq_max")


def pad(df: DataFrame, signals: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """A row for every signal of ``signals`` (of ``keep`` only, if given); unknown signals go."""
    if keep is not None:
        signals = signals.where(F.col("sid").isin(list(keep)))
    return signals.select("sid").join(df, "sid", "left")


def unknown_signals(df: DataFrame, signals: DataFrame) -> DataFrame:
    return df.join(signals, "sid", "left_anti").select("sid").distinct()


def expand_satellites(by_satellite: DataFrame, signals: DataFrame) -> DataFrame:
    """Values per satellite for each of its signals; unknown satellites go."""
    return by_satellite.join(signals.select("sv", "sid"), "sv").drop("sv")


def prefer_bands(df: DataFrame, groups: DataFrame, preference: dict[str, str] | None) -> DataFrame:
    """Of each overlap group with a preferred band, that band's rows only."""
    if not preference:
        return df
    band = F.split("sid", r"\|").getItem(1)
    wanted = df.sparkSession.createDataFrame(list(preference.items()), "overlap_group string, wanted string")
    known = df.withColumn("band_", band).join(groups.select(F.col("band").alias("band_"), "overlap_group"), "band_", "left").join(wanted, "overlap_group", "left")
    return known.where(F.col("wanted").isNull() | (F.col("wanted") == F.col("band_"))).select(*df.columns)


def merge_codes(df: DataFrame, value: str = "snr") -> DataFrame:
    """One value per epoch, satellite and band: that of the first code in order that has one."""
    p = F.split("sid", r"\|")
    known = df.where(F.col(value).isNotNull()).select("epoch", p.getItem(0).alias("sv"), p.getItem(1).alias("band"), p.getItem(2).alias("code"), value)
    return known.groupBy("epoch", "sv", "band").agg(F.min_by(value, "code").alias(value))


def number_ranges(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(NUMBER_RANGES, "lo int, hi int, system string, shift int")

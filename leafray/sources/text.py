"""Readers of line-based products: orbits (SP3), clocks (CLK), NMEA sentences, validity blocks (SINEX), observations (RINEX).

Files are read with Spark's text and binaryFile sources, so any file system
that Spark knows will do. Products with one record per line are split into
columns in the JVM; formats whose lines depend on the lines before are parsed
file by file, since one file is a day or less of one receiver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafray.functions.gnss import nmea_valid
from leafray.operators.ordered import last_said


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line, value; files are read by byte ranges.

    ``line`` orders the lines of a file: ``start`` is where its byte range
    begins, ``row`` counts on over the ranges of all files. Lines end with a line
    feed, before which a carriage return doesn't count; the last one of a file begins no
    further line.
    """
    value = F.when(F.col("value").endswith("\r"), F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    line = F.struct(F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row"))
    return spark.read.text(path, lineSep="\n").select(F.input_file_name().alias("file"), line.alias("line"), value.alias("value"))


def _epoch(*parts: Column) -> Column:
    y, mo, d, h, mi = parts
    return F.make_timestamp_ntz(y, mo, d, h, mi, F.lit(0))


def read_sp3(spark: SparkSession, path: str) -> DataFrame:
    """epoch, sv, x, y, z in metres; the value 999999.999999 means missing. Seconds of epochs are dropped."""
    lines = numbered_lines(spark, path)
    w = Window.partitionBy("file").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    t = F.split(F.trim("value"), r"\s+")
    number = lambda i: t.getItem(i).try_cast("int")
    head = F.when(F.col("value").startswith("*"), _epoch(number(1), number(2), number(3), number(4), number(5)))
    known = lines.withColumn("epoch", F.last(head, ignorenulls=True).over(w)).where(F.col("value").startswith("P"))
    axis = lambda k: F.trim(F.substring("value", 5 + 14 * k, 14))
    metres = lambda k: F.when(axis(k) != "999999.999999", axis(k).try_cast("double") * 1000)
    return known.select("epoch", F.trim(F.substring("value", 2, 3)).alias("sv"), *[metres(k).alias(a) for k, a in enumerate("xyz")])


def read_clk(spark: SparkSession, path: str, scale: float = 1.0) -> DataFrame:
    """epoch, sv, clock of satellite records; of repeated ones the last line counts. ``scale`` turns the file's unit into seconds."""
    t = F.split(F.trim("value"), r"\s+")
    number = lambda i: t.getItem(i).try_cast("double").cast("int")
    epoch = F.make_timestamp_ntz(number(2), number(3), number(4), number(5), number(6), number(7))
    rows = numbered_lines(spark, path).where(F.col("value").startswith("AS "))
    rows = rows.select(epoch.alias("epoch"), t.getItem(1).alias("sv"), (t.getItem(9).try_cast("double") * scale).alias("clock"), "file", "line")
    return rows.groupBy("epoch", "sv").agg(F.max_by("clock", F.struct("file", "line")).alias("clock"))


def read_validity(spark: SparkSession, path: str, block: str) -> DataFrame:
    """Fields of one SINEX block's lines: file, line, fields (array); comments are left out."""
    lines = numbered_lines(spark, path)
    mark = F.when(F.col("value").startswith("+"), F.substring("value", 2, 80)).when(F.col("value").startswith("-"), F.lit(""))
    inside = last_said(lines, F.trim(mark), "block")
    inside = inside.where((F.col("block") == block) & ~F.col("value").rlike(r"^[+\-*%]"))
    return inside.select("file", "line", F.split(F.trim("value"), r"\s+").alias("fields"))


def satellites_in_view(sentence: Column) -> Column:
    """Satellites and strengths of a satellites-in-view sentence; sv is null where the number belongs to no system."""
    f = F.split(F.regexp_extract(sentence, r"^\$([^*]*)", 1), ",")
    talker = F.substring(f.getItem(0), 1, 2)
    places = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(f) - 4) / 4) - 1).cast("int"))

    def satellite(i: Column) -> Column:
        prn = F.try_element_at(f, (5 + i * 4).cast("int")).try_cast("int")
        numbered = lambda system, n: F.concat(F.lit(system), F.lpad(n.cast("string"), 2, "0"))
        sv = (
            F.when((talker == "GP") & prn.between(33, 64), numbered("S", prn - 13))
            .when(talker == "GP", numbered("G", prn))
            .when((talker == "GL") & (prn > 64), numbered("R", prn - 64))
            .when(talker == "GL", numbered("R", prn))
            .when(talker == "GA", numbered("E", prn))
            .when(talker.isin("GB", "BD"), numbered("C", prn))
        )
        return F.struct(sv.alias("sv"), F.try_element_at(f, (8 + i * 4).cast("int")).try_cast("double").alias("snr"))

    return F.transform(places, satellite)


def read_nmea(spark: SparkSession, path: str) -> DataFrame:
    """epoch (seconds of day), sv, snr from satellites-in-view sentences; bad checksums are dropped.

    A new epoch begins where the time of a position sentence changes. Per epoch
    and satellite the greatest strength stays; missing ones lose.
    """
    lines = numbered_lines(spark, path).where(nmea_valid(F.col("value")))
    f = F.split(F.regexp_extract("value", r"^\$([^*]*)", 1), ",")
    kind = F.substring(f.getItem(0), 3, 3)
    stamp = F.when(kind.isin("RMC", "GGA") & (F.length(f.getItem(1)) >= 6), f.getItem(1))
    seconds = F.substring(stamp, 1, 2).try_cast("int") * 3600 + F.substring(stamp, 3, 2).try_cast("int") * 60 + F.substring(stamp, 5, 10).try_cast("double")
    w = Window.partitionBy("file").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    known = lines.withColumn("epoch", F.last(seconds, ignorenulls=True).over(w)).where((kind == "GSV") & F.col("epoch").isNotNull())
    sats = known.select("file", "epoch", F.explode(satellites_in_view(F.col("value"))).alias("b")).select("file", "epoch", "b.sv", "b.snr")
    return sats.where("sv is not null").groupBy("file", "epoch", "sv").agg(F.max("snr").alias("snr"))


# Band names by system and the digit of an observation code.
BAND_OF_DIGIT = {
    "G": {"1": "L1", "2": "L2", "5": "L5"},
    "E": {"1": "E1", "5": "E5a", "7": "E5b", "8": "E5", "6": "E6"},
    "R": {"1": "G1", "2": "G2", "3": "G3"},
    "C": {"2": "B1I", "1": "B1C", "5": "B2a", "7": "B2b", "6": "B3I"},
    "J": {"1": "L1", "2": "L2", "5": "L5", "6": "L6"},
    "S": {"1": "L1", "5": "L5"},
    "I": {"5": "L5", "9": "S"},
}


def read_rinex3(spark: SparkSession, path: str) -> DataFrame:
    """Observations of RINEX 3 files, as ``leafray.sources.rinex3`` reads them."""
    from leafray.sources import rinex3

    return rinex3.read_rinex3(spark, path)


def violations(df: DataFrame, required: dict[str, str]) -> list[str]:
    """All columns of a contract that are absent or have another type."""
    have = dict(df.dtypes)
    return [f"{c}: {have.get(c, 'absent')}, not {t}" for c, t in required.items() if have.get(c) != t]


def file_listing(spark: SparkSession, path: str) -> DataFrame:
    """path, name, size, digest, and the year and day of a canonical file name, for catalogues and duplicate checks."""
    name = F.element_at(F.split("path", "/"), -1)
    pattern = r"^([A-Z0-9]{3})([A-Z])(\d{2})([A-Z]{3})_R_(\d{4})(\d{3})(\d{4})_([0-9A-Z]+)_([0-9A-Z]+)_([A-Z]{2})\.(.+)$"
    files = spark.read.format("binaryFile").load(path)
    part = lambda i: F.regexp_extract(name, pattern, i)
    return files.select("path", name.alias("name"), F.col("length").alias("size"), F.substring(F.sha2("content", 256), 1, 16).alias("digest"), part(1).alias("site"), part(5).try_cast("int").alias("year"), part(6).try_cast("int").alias("doy"), part(8).alias("period"), part(9).alias("sampling"), part(11).alias("type"))
